"""Stations and point-in-polygon against brute force."""

import json
import random

import pytest
from pyspark.sql import functions as F

from pedalgrid.operators import geo
from pedalgrid.plans import demand
from pedalgrid.sources import readers
from verification import warehouse

SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
HOLE = [[1, 1], [1, 2], [2, 2], [2, 1], [1, 1]]
NEXT = [[4, 0], [8, 0], [8, 4], [4, 4], [4, 0]]
OVER = [[3, 3], [6, 3], [6, 6], [3, 6], [3, 3]]
FAR = [[[[10, 10], [12, 10], [11, 12], [10, 10]]], [[[10, 0], [12, 0], [11, 2], [10, 0]]]]


def feature(kind, coordinates, **properties):
    geometry = None if kind is None else {"type": kind, "coordinates": coordinates}
    return {"type": "Feature", "properties": properties, "geometry": geometry}


FEATURES = [
    feature(None, None, boroname="Nowhere"),
    feature("Polygon", [SQUARE, HOLE], boroname="Square"),
    feature("Polygon", [NEXT], boroname="", boro_name="Next"),
    feature("Polygon", [OVER], BoroName="Over"),
    feature("MultiPolygon", FAR, other="x"),
]


@pytest.fixture(params=["collection", "list"])
def polygons(request, spark, tmp_path):
    document = {"type": "FeatureCollection", "features": FEATURES} if request.param == "collection" else FEATURES
    path = tmp_path / "shapes.geojson"
    path.write_text(json.dumps(document, indent=1))
    return readers.read_polygons(spark, str(path))


def test_polygon_names(polygons):
    names = [r.name for r in polygons.orderBy("poly_order").collect()]
    assert names == ["Square", "Next", "Over", "Unknown"]


def test_no_polygons_is_an_error(spark, tmp_path):
    (tmp_path / "none.geojson").write_text(json.dumps({"features": [FEATURES[0]]}))
    with pytest.raises(ValueError):
        readers.read_polygons(spark, str(tmp_path / "none.geojson"))


@pytest.mark.parametrize("band", [0.25, 1.0, 100.0])
def test_points(spark, polygons, band):
    cases = [
        ((0.5, 0.5), "Square"),
        ((1.5, 1.5), "Other"),  # in the hole
        ((1.0, 1.5), "Square"),  # on the rim of the hole
        ((4.0, 1.0), "Square"),  # on the shared border, first in the list
        ((4.0, 4.0), "Square"),  # shared corner
        ((0.0, 0.0), "Square"),
        ((2.0, 0.0), "Square"),  # on a horizontal edge
        ((5.0, 1.0), "Next"),
        ((3.5, 3.5), "Square"),  # overlap
        ((5.0, 3.5), "Next"),
        ((5.0, 5.0), "Over"),
        ((11.0, 11.0), "Unknown"),
        ((11.0, 1.0), "Unknown"),
        ((11.0, 2.0), "Unknown"),  # apex
        ((11.0, 5.0), "Other"),  # level with nothing
        ((-1.0, 4.0), "Other"),  # left of an edge's line
        ((-1.0, 1.0), "Other"),
    ]
    points = spark.createDataFrame([(i, x, y) for i, ((x, y), _) in enumerate(cases)], "id int, longitude double, latitude double")
    bands = geo.Bands(geo.banded_polygons(geo.polygon_edges(polygons), band), band)
    got = geo.point_in_polygon(points, bands).orderBy("id").collect()
    assert [r.borough for r in got] == [name for _, name in cases]


def brute_force(x, y):
    for name, kind, coordinates in warehouse.SHAPES:
        odd = False
        for part in coordinates if kind == "MultiPolygon" else [coordinates]:
            for ring in part:
                for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                    if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                        odd = not odd
        if odd:
            return name
    return "Other"


def test_crowded_band_against_brute_force(spark):
    random.seed(3)
    # A third of the points share one height, so one band is crowded.
    xy = [(random.uniform(-0.45, 0.35), 0.101 if i % 3 == 0 else random.uniform(-0.35, 0.35)) for i in range(1500)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(xy)], "id int, longitude double, latitude double")
    bands = geo.Bands(geo.banded_polygons(geo.polygon_edges(warehouse.polygons(spark)), 0.05), 0.05)
    got = geo.point_in_polygon(points, bands).orderBy("id").collect()
    assert [r.borough for r in got] == [brute_force(x, y) for x, y in xy]


def test_repeated_points_keep_their_rows_and_are_not_moved(spark, polygons):
    points = spark.createDataFrame([(1.0, 0.5)] * 3 + [(50.0, 50.0)] * 2, "longitude double, latitude double")
    located = geo.point_in_polygon(points, demand.measured_bands(polygons))
    assert sorted(r.borough for r in located.collect()) == ["Other", "Other", "Square", "Square", "Square"]
    plan = located._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Aggregate" not in plan


@pytest.mark.parametrize("unit", [1.0, 1e-4, 3e5])
def test_bands_follow_the_extent(spark, polygons, unit):
    edges = geo.polygon_edges(polygons).selectExpr("poly_order", "name", *[f"{c} * {unit} AS {c}" for c in ("x1", "y1", "x2", "y2")])
    height = geo.band_height(edges)
    banded = geo.banded_polygons(edges, height)
    assert banded.count() <= geo.BANDS + 2
    points = spark.createDataFrame([(0.5 * unit, 0.5 * unit), (5.0 * unit, 5.0 * unit)], "longitude double, latitude double")
    assert [r.borough for r in geo.point_in_polygon(points, geo.Bands(banded, height)).collect()] == ["Square", "Over"]


def test_stations_from_rides(spark, polygons, rows):
    rides = spark.createDataFrame(
        [
            (1, " A ", "bad position", "x", "1"),
            (2, "A", " first ", "0.5", "0.5"),
            (3, "A", "later", "5.0", "5.0"),
            (4, None, "none", "1", "1"),
            (5, " ", "blank", "1", "1"),
            (6, "B", None, "50", "50"),
            (7, "A", "first", "9", "9"),
        ],
        "n bigint, start_station_id string, start_station_name string, start_lat string, start_lng string",
    )
    stations = demand.build_stations(rides, polygons, "n", band=0.5)
    assert rows(stations) == [("A", "first", 0.5, 0.5, "Square"), ("B", "", 50.0, 50.0, "Other")]
    assert rows(geo.borough_counts(stations)) == [("Other", 1), ("Square", 1)]
    assert rows(geo.unmatched(stations)) == [(1, 2)]


def test_first_station_by_load_order(spark, tmp_path, rows):
    for month, name in (("202506", "old"), ("202507", "new")):
        line = f"r,b,2025-06-01 10:00:00,2025-06-01 10:05:00,{name},A,x,y,1,2,3,4,member\n"
        (tmp_path / f"{month}.csv").write_text(line)
    rides = readers.read_rides(spark, str(tmp_path)).withColumn(readers.LOAD_ORDER, readers.load_order())
    assert rows(geo.unique_stations(rides, readers.LOAD_ORDER)) == [("A", "old", 1.0, 2.0)]
    assert rides.select(F.countDistinct(readers.LOAD_ORDER)).collect()[0][0] == 2
    plan = geo.unique_stations(rides, readers.LOAD_ORDER)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(start_station_id") :].split("Exchange", 2)[2]
    assert "SortAggregate" not in below


def test_written_station_lookup(spark, polygons, tmp_path, rows):
    line = "r{0},b,2025-06-01 10:00:00,2025-06-01 10:05:00,S{0},{0},x,y,{1},{2},3,4,member\n"
    (tmp_path / "202506.csv").write_text("".join(line.format(*v) for v in (("A", 0.5, 0.5), ("B", 50, 50))))
    rides = readers.read_rides(spark, str(tmp_path / "202506.csv")).withColumn(readers.LOAD_ORDER, readers.load_order())
    built = demand.write_station_lookup(rides, polygons, str(tmp_path / "lookup"))
    assert rows(built.stations) == [("A", "SA", 0.5, 0.5, "Square"), ("B", "SB", 50.0, 50.0, "Other")]
    assert rows(built.per_borough) == [("Other", 1), ("Square", 1)] and rows(built.outside) == [(1, 2)]
