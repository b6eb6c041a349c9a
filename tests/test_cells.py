"""Points in polygons through the grid, against bands and against plain ray casting."""

import json
import random

import pytest
from pyspark.sql import functions as F

from pedalgrid.operators import cells, geo
from pedalgrid.plans import demand
from pedalgrid.session import staged
from pedalgrid.sources.readers import polygons_from_features
from verification import warehouse


def polygons(spark, shapes):
    rows = [(i, {"boroname": n}, {"type": "Polygon", "coordinates": json.dumps(c)}) for i, (n, c) in enumerate(shapes)]
    layout = "pos int, properties map<string,string>, geometry struct<type:string,coordinates:string>"
    features = spark.createDataFrame(rows, layout).select("pos", F.struct("properties", "geometry").alias("feature"))
    return polygons_from_features(features, F.col("feature"), F.col("pos"))


def plain(shapes, x, y):
    """Exact ray casting over whole numbers, edges included; the first polygon wins."""
    for name, rings in shapes:
        odd = touched = False
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                side = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
                if side == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                    touched = True
                if (y1 <= y < y2 and side > 0) or (y2 <= y < y1 and side < 0):
                    odd = not odd
        if odd or touched:
            return name
    return "Other"


def star(draw, k):
    """A polygon on whole coordinates around a middle point, concave as often as not."""
    import math

    mx, my = draw.randrange(10, 40), draw.randrange(10, 40)
    turns = sorted(draw.sample(range(48), draw.choice([3, 5, 9, 17])))
    ring = [[mx + round(r * math.cos(t * math.pi / 24)), my + round(r * math.sin(t * math.pi / 24))] for t in turns for r in [draw.randrange(2, 16)]]
    return f"P{k}", [ring + ring[:1]]


@pytest.mark.parametrize("side", [1.0, 2.0, 3.7, 60.0])
def test_whole_coordinates_meet_every_tie(spark, side):
    """Corners of cells, vertices, edges along borders: points, edges and grid share their coordinates."""
    draw = random.Random(int(side * 10))
    shapes = [star(draw, k) for k in range(12)]
    shapes += [("Box", [[[4, 4], [20, 4], [20, 20], [4, 20], [4, 4]], [[8, 8], [12, 8], [12, 12], [8, 12], [8, 8]]]), ("Line", [[[0, 30], [45, 30], [0, 30]]])]
    points = [(x / 2, y / 2) for x in range(-2, 104) for y in range(-2, 104)]
    table = spark.createDataFrame(points, "longitude double, latitude double")
    got = cells.point_in_cells(table, demand.measured_cells(polygons(spark, shapes), side))
    wrong = [(r["longitude"], r["latitude"], r["borough"]) for r in got.collect() if r["borough"] != plain(shapes, r["longitude"], r["latitude"])]
    assert wrong == [] and got.count() == len(points)


def test_equals_bands_and_keeps_rows(spark):
    shapes = warehouse.polygons(spark)
    draw = random.Random(5)
    rows = [(draw.uniform(-0.5, 0.5), draw.uniform(-0.5, 0.5), "x") for _ in range(3000)] + [(None, 0.1, "y"), (float("nan"), 0.0, "z"), (0.05, 0.05, "v")] * 2
    points = spark.createDataFrame(rows, "longitude double, latitude double, _cx string")
    points = points.withColumnRenamed("_cx", "cell_x")
    a = cells.point_in_cells(points, demand.measured_cells(shapes))
    b = geo.point_in_polygon(points, demand.measured_bands(shapes))
    assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_most_cells_have_no_edges(spark):
    table = demand.measured_cells(warehouse.polygons(spark)).table
    covering = table.where(F.exists("shapes", lambda s: s["edges"].isNull()))
    assert covering.count() > 0.8 * table.count()
    # Nothing stands behind a shape that covers the cell.
    assert table.where(F.exists(F.slice("shapes", 1, F.greatest(F.size("shapes") - 1, F.lit(0))), lambda s: s["edges"].isNull())).isEmpty()


def test_a_hot_cell_is_split(spark, tmp_path):
    """Cells too large to broadcast, a third of the points in one cell: the join is split and keeps every row."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    grid = demand.measured_cells(warehouse.polygons(spark), 0.01)
    points = spark.range(120_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(-0.15)).otherwise(F.rand(3) - 0.5).alias("longitude"),
        F.when(F.col("id") % 3 == 0, F.lit(-0.25)).otherwise(F.rand(4) - 0.5).alias("latitude"),
    )
    points = staged(points.repartition(12), "points")
    want = {r["borough"]: r["n"] for r in geo.point_in_polygon(points, demand.measured_bands(warehouse.polygons(spark))).groupBy("borough").agg(F.count("*").alias("n")).collect()}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        got = cells.point_in_cells(points, grid)
        got.write.parquet(str(tmp_path / "located"))
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "SortMergeJoin(skew=true)" in plan
    located = spark.read.parquet(str(tmp_path / "located")).groupBy("borough").agg(F.count("*").alias("n"))
    assert {r["borough"]: r["n"] for r in located.collect()} == want
