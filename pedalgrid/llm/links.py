"""Connected components of a table of links, by alternating star steps. Nothing reaches the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalgrid.session import staged



def _least(edges: DataFrame) -> DataFrame:
    """``a``, and the smallest of itself and its neighbours; counted in each task before anything moves."""
    return edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def contracted(edges: DataFrame) -> DataFrame:
    """``id, parent``: one round of both stars, enough to say of most linked ids that they belong together.

    An id and its parent are connected; connected ids may still have different parents.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    both = staged(_both(edges), "both")
    large = staged(both.where("b > a").join(staged(_least(both), "least"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")), "large")
    least = staged(_least(large), "least")
    small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ends = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b")
    return ends.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("parent"))


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every id of the links ``a, b``; the component is the smallest id it reaches.

    Each round hangs every larger neighbour of a node on its least neighbour (large star), then every
    smaller one (small star), until nothing moves: about as many rounds as the logarithm of the longest
    chain. Joins are between written tables, so a node with very many links is split over tasks.
    """
    edges = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = _both(edges)
        least = staged(_least(both), "least")
        # Large star: of a node's neighbours, those larger than it go to the least.
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = staged(large, "large")
        # Small star: a node and its smaller neighbours go to the least of them.
        least = staged(_least(large), "least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        after = staged(small.where("a <> b").distinct(), "small")
        if after.count() == edges.count() and after.exceptAll(edges).isEmpty():
            break
        edges = after
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
