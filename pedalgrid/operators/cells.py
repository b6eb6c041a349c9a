"""Point in polygon through a grid: a point meets only the edges that pass through its own cell.

Each cell lists the polygons that it touches in list order. A polygon either covers the cell, then every point
of the cell is in it and no edge is looked at, or it has edges in the cell. Polygons behind one that covers the
cell are left out, as the first one wins. For a polygon with edges in the cell the list also says
whether the cell's upper right corner is inside; a point is inside if the way from it to the corner, first to the
right and then up, crosses an odd number of edges less the corner's own state. All of that way lies in the cell.

Ties are broken as if the corner lay a little to the right and the point a little, but much less, higher.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalgrid.schemas import OTHER_BOROUGH

#: Cells along the longer side of the extent, about.
CELLS = 256
#: Share of a cell by which edges reach into neighbouring cells, so that none is missed by rounding.
_MARGIN = 1e-6
_EDGE = ("x1", "y1", "x2", "y2")


class Cells(NamedTuple):
    """``polygon_cells`` and the length of a cell's side."""

    table: DataFrame
    size: float


def cell_size(edges: DataFrame, cells: int = CELLS) -> float:
    """Side that cuts the longer side of the polygons' extent into about ``cells`` cells."""
    low_x, high_x, low_y, high_y = edges.agg(F.min(F.least("x1", "x2")), F.max(F.greatest("x1", "x2")), F.min(F.least("y1", "y2")), F.max(F.greatest("y1", "y2"))).first()
    longest = max(high_x - low_x, high_y - low_y) if low_x is not None else 0
    return longest / cells if longest > 0 else 1.0


def _number(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(size)).cast("bigint")


def _cross(e, px: Column, py: Column) -> Column:
    """Positive if the point is to the left of the edge as it runs, negative to the right, zero on its line."""
    return (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])


def _beyond(e, px: Column, py: Column) -> Column:
    """Whether the edge crosses the ray from the point to the right."""
    up, down = (e["y1"] <= py) & (e["y2"] > py), (e["y2"] <= py) & (e["y1"] > py)
    return (up & (_cross(e, px, py) > 0)) | (down & (_cross(e, px, py) < 0))


def _above(e, px: Column, py: Column) -> Column:
    """Whether the edge crosses the ray from the point upwards; a rising edge through the point counts as above it."""
    east, west = (e["x1"] <= px) & (e["x2"] > px), (e["x2"] <= px) & (e["x1"] > px)
    side, rises = _cross(e, px, py), (e["x2"] - e["x1"]) * (e["y2"] - e["y1"]) > 0
    return (east & (side < 0)) | (west & (side > 0)) | ((east | west) & (side == 0) & rises)


def _touches(e, px: Column, py: Column) -> Column:
    across = px.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
    along = py.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    return across & along & (_cross(e, px, py) == 0)


def _edges_by_cell(edges: DataFrame, size: float) -> DataFrame:
    """Every edge in each cell that it passes through or comes within a margin of."""
    margin = F.lit(size * _MARGIN)
    low, high = F.least("x1", "x2"), F.greatest("x1", "x2")
    columns = edges.withColumn("cell_x", F.explode(F.sequence(_number(low - margin, size), _number(high + margin, size))))
    steep = (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))

    def height(x: Column) -> Column:
        """Where the edge is at a border of the column, or at its own end before that."""
        inside = F.least(F.greatest(x, low), high)
        return F.when(F.col("x1") == F.col("x2"), F.col("y1")).otherwise(F.col("y1") + (inside - F.col("x1")) * steep)

    left, right = height(F.col("cell_x") * size - margin), height((F.col("cell_x") + 1) * size + margin)
    upright = F.col("x1") == F.col("x2")
    bottom = F.when(upright, F.least("y1", "y2")).otherwise(F.least(left, right))
    top = F.when(upright, F.greatest("y1", "y2")).otherwise(F.greatest(left, right))
    return columns.withColumn("cell_y", F.explode(F.sequence(_number(bottom - margin, size), _number(top + margin, size))))


def _edges_by_line(edges: DataFrame, size: float) -> DataFrame:
    """``poly_order, cell_y, edges``: of each polygon the edges that cross the upper border of a row of cells."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    # The border of row r is at (r + 1) * size; edges are cut in general a row too far on both sides and then tested.
    rows = edges.withColumn("cell_y", F.explode(F.sequence(_number(low, size) - 2, _number(high, size))))
    line = (F.col("cell_y") + 1) * size
    across = ((F.col("y1") <= line) & (F.col("y2") > line)) | ((F.col("y2") <= line) & (F.col("y1") > line))
    return rows.where(across).groupBy("poly_order", "name", "cell_y").agg(F.collect_list(F.struct(*_EDGE)).alias("line_edges"))


def polygon_cells(edges: DataFrame, size: float) -> DataFrame:
    """``cell_x, cell_y, shapes``: per cell the polygons that touch it, in list order, up to the first that covers it.

    A shape has the ``edges`` in the cell and whether its upper right ``corner`` is inside, or no edges if it covers the cell.
    """
    near = _edges_by_cell(edges, size)
    crossed = near.groupBy("poly_order", "name", "cell_x", "cell_y").agg(F.collect_list(F.struct(*_EDGE)).alias("edges"))
    lines = _edges_by_line(edges, size)
    right, upper = (F.col("cell_x") + 1) * size, (F.col("cell_y") + 1) * size
    corners = crossed.join(lines.drop("name"), ["poly_order", "cell_y"], "left")
    beyond = F.size(F.filter(F.coalesce("line_edges", F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")), lambda e: _beyond(e, right, upper)))
    corners = corners.select("poly_order", "name", "cell_x", "cell_y", "edges", (beyond % 2 == 1).alias("corner"))

    # Along a border the crossings come in pairs; cells whose corner lies between the two of a pair are inside.
    at = F.transform("line_edges", lambda e: e["x1"] + (upper - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"]))
    sorted_lines = lines.withColumn("xs", F.array_sort(at))
    pairs = sorted_lines.select("poly_order", "name", "cell_y", F.explode(F.sequence(F.lit(0), F.size("xs") - 2, F.lit(2))).alias("k"), "xs")
    first, last = F.col("xs")[F.col("k")], F.col("xs")[F.col("k") + 1]
    spans = pairs.select("poly_order", "name", "cell_y", _number(first, size).alias("a"), (F.ceil(last / F.lit(size)) - 2).cast("bigint").alias("b"))
    covered = spans.where("a <= b").withColumn("cell_x", F.explode(F.sequence("a", "b"))).select("poly_order", "name", "cell_x", "cell_y").distinct()
    covered = covered.join(crossed.select("poly_order", "cell_x", "cell_y"), ["poly_order", "cell_x", "cell_y"], "left_anti")
    none = F.lit(None).cast("array<struct<x1:double,y1:double,x2:double,y2:double>>").alias("edges")
    whole = covered.select("poly_order", "name", "cell_x", "cell_y", none, F.lit(True).alias("corner"))

    # Only shapes up to the first that covers the cell can win there.
    every = corners.unionByName(whole)
    winner = whole.groupBy("cell_x", "cell_y").agg(F.min("poly_order").alias("first"))
    kept = every.join(winner, ["cell_x", "cell_y"], "left").where(F.col("first").isNull() | (F.col("poly_order") <= F.col("first")))
    shape = F.struct("poly_order", "name", "corner", "edges")
    return kept.groupBy("cell_x", "cell_y").agg(F.array_sort(F.collect_list(shape)).alias("shapes"))


def point_in_cells(points: DataFrame, cells: Cells, x: str = "longitude", y: str = "latitude") -> DataFrame:
    """``points`` with ``borough``: the first polygon, in list order, that contains or touches the point, else ``Other``.

    One equality join on the cell. There is no broadcast hint: with a written table Spark broadcasts
    the cells if they are small; else points are shuffled, and adaptive execution splits a cell that has very many.
    Every row of ``points`` gives one row; points without coordinates are ``Other``.
    """
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    size = cells.size
    placed = points.withColumns({"_cx": _number(px, size), "_cy": _number(py, size)})
    right, upper = (F.col("_cx") + 1) * size, (F.col("_cy") + 1) * size

    def odd(e) -> Column:
        return (_beyond(e, px, py) != _beyond(e, right, py)).cast("int") + (_above(e, right, py) != _above(e, right, upper)).cast("int")

    def holds(shape) -> Column:
        crossings = F.aggregate(shape["edges"], F.lit(0), lambda n, e: n + odd(e))
        inside = (crossings + shape["corner"].cast("int")) % 2 == 1
        return F.when(shape["edges"].isNull(), True).otherwise(F.exists(shape["edges"], lambda e: _touches(e, px, py)) | inside)

    table = cells.table.select(F.col("cell_x").alias("_tx"), F.col("cell_y").alias("_ty"), "shapes")
    joined = placed.join(table, (F.col("_cx") == F.col("_tx")) & (F.col("_cy") == F.col("_ty")), "left")
    name = F.get(F.filter("shapes", holds), F.lit(0))["name"]
    return joined.select(*points.columns, F.coalesce(name, F.lit(OTHER_BOROUGH)).alias("borough"))
