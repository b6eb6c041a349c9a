"""Stations and the point-in-polygon join."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalgrid.schemas import OTHER_BOROUGH, STATIONS

#: Bands over the extent of the polygons, about.
BANDS = 512


def unique_stations(rides: DataFrame, order: str) -> DataFrame:
    """Per trimmed station id the name and position of the first ride, by ``order``, with usable coordinates.

    ``order`` is a number, or a struct that ends in one, as ``readers.load_order`` makes it. The first
    pass keeps one number triple per (id, name, file, block), which a hash aggregation combines before
    the shuffle; the second settles the few rows that are left of an id.
    """
    order_type = rides.schema[order].dataType
    parts = order_type.names if order_type.typeName() == "struct" else []
    located = rides.select(
        F.trim("start_station_id").alias("start_station_id"),
        F.trim(F.coalesce("start_station_name", F.lit(""))).alias("station_name"),
        F.col("start_lat").try_cast("double").alias("latitude"),
        F.col("start_lng").try_cast("double").alias("longitude"),
        *[F.col(order)[p].alias(f"_{p}") for p in parts[:-1]],
        (F.col(order)[parts[-1]] if parts else F.col(order)).alias("_row"),
    ).filter((F.col("start_station_id") != "") & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    # File and block are keys here, so that only plain row numbers are compared while rides are combined.
    within = [f"_{p}" for p in parts[:-1]]
    named = located.groupBy("start_station_id", "station_name", *within).agg(
        F.min_by("latitude", "_row").alias("latitude"),
        F.min_by("longitude", "_row").alias("longitude"),
        F.min("_row").alias("_row"),
    )
    first = named.groupBy("start_station_id").agg(
        F.min_by(F.struct("station_name", "latitude", "longitude"), F.struct(*within, "_row")).alias("s")
    )
    return first.select("start_station_id", "s.*")


def polygon_edges(polygons: DataFrame) -> DataFrame:
    """One row per edge ``(poly_order, name, x1, y1, x2, y2)`` of all parts and rings, holes included."""
    rings = polygons.select("poly_order", "name", F.explode(F.flatten("parts")).alias("ring"))
    # Rings repeat their first point at the end; doing it again only adds an edge without length.
    closed = rings.withColumn("ring", F.concat("ring", F.slice("ring", 1, 1)))
    pairs = F.arrays_zip(
        F.slice("ring", F.lit(1), F.size("ring") - 1).alias("a"), F.slice("ring", F.lit(2), F.size("ring") - 1).alias("b")
    )
    edges = closed.select("poly_order", "name", F.explode(pairs).alias("e"))
    a, b = F.col("e.a"), F.col("e.b")
    return edges.select(
        "poly_order", "name", a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")
    )


def _band(y: Column, height: float) -> Column:
    return F.floor(y / F.lit(height)).cast("bigint")


def band_height(edges: DataFrame, bands: int = BANDS) -> float:
    """Height that cuts the extent of the polygons into about ``bands`` bands."""
    low, high = edges.agg(F.min(F.least("y1", "y2")), F.max(F.greatest("y1", "y2"))).first()
    return (high - low) / bands if low is not None and high > low else 1.0


def banded_polygons(edges: DataFrame, band: float) -> DataFrame:
    """One row per horizontal band of height ``band``: ``shapes``, in list order, with the edges of each that reach it."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    reached = edges.withColumn("_band", F.explode(F.sequence(_band(low, band), _band(high, band))))
    per_shape = reached.groupBy("_band", "poly_order", "name").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))
    return per_shape.groupBy("_band").agg(F.array_sort(F.collect_list(F.struct("poly_order", "name", "edges"))).alias("shapes"))


class Bands(NamedTuple):
    """``banded_polygons`` and the height of its bands."""

    table: DataFrame
    height: float


def point_in_polygon(points: DataFrame, bands: Bands, x: str = "longitude", y: str = "latitude") -> DataFrame:
    """``points`` with ``borough``: the first polygon, in list order, that contains or touches the point.

    A point meets the shapes of its own band only, by an equality join of one row, and counts the edges
    that the ray to its right crosses: an odd number means inside, which also handles holes and
    multi-part shapes. Points on an edge are inside. Points of no polygon get ``Other``. Every row of
    ``points`` gives one row, repeated ones too; while the bands are broadcast no point is moved.
    """
    px, py = F.col(x), F.col(y)

    def cross(e: Column) -> Column:
        return (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])

    def touches(e: Column) -> Column:
        across = px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        along = py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        return across & along & (cross(e) == 0)

    def crosses(e: Column) -> Column:
        # Half-open in y, so that a vertex is counted once; the sign of the cross product tells the side of the edge.
        up, down = (e["y1"] <= py) & (e["y2"] > py), (e["y2"] <= py) & (e["y1"] > py)
        return (up & (cross(e) > 0)) | (down & (cross(e) < 0))

    def holds(shape: Column) -> Column:
        return F.exists(shape["edges"], touches) | (F.size(F.filter(shape["edges"], crosses)) % 2 == 1)

    joined = points.withColumn("_at", _band(py, bands.height)).join(bands.table, F.col("_at") == F.col("_band"), "left")
    name = F.get(F.filter("shapes", holds), F.lit(0))["name"]
    return joined.select(*points.columns, F.coalesce(name, F.lit(OTHER_BOROUGH)).alias("borough"))


def assign_stations(stations: DataFrame, bands: Bands) -> DataFrame:
    return point_in_polygon(stations, bands).select(*STATIONS.names)


def borough_counts(stations: DataFrame) -> DataFrame:
    return stations.groupBy("borough").agg(F.count("*").alias("stations"))


def unmatched(stations: DataFrame) -> DataFrame:
    """How many stations lie outside all polygons, and how many there are."""
    outside = F.count(F.when(F.col("borough") == OTHER_BOROUGH, 1))
    return stations.agg(outside.alias("outside"), F.count("*").alias("stations"))
