"""Group statistics with the floor-index quantile."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pedalgrid.functions.measures import average_2dp
from pedalgrid.schemas import DEMAND_QUANTILES, EVENT_QUANTILES, MEASURE, STAGE_TABLES


PAGES = 16


def _picks(quantiles: Mapping[str, float], value: str) -> list[Column]:
    """The value whose rank range covers the zero-based index ``floor(q * (n - 1))``."""
    picks = []
    for name, q in quantiles.items():
        index = F.floor(F.lit(float(q)) * (F.col("_total") - 1))
        picks.append(F.max(F.when((F.col("_before") <= index) & (index < F.col("_upto")), F.col(value))).alias(name))
    return picks


def _histogram(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))


def _ranked(hist: DataFrame, keys: list[str], value: str) -> DataFrame:
    group = W.partitionBy(*keys)
    running = F.sum("_n").over(group.orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow))
    return (
        hist.withColumn("_upto", running)
        .withColumn("_before", F.col("_upto") - F.col("_n"))
        .withColumn("_total", F.sum("_n").over(group))
    )


def quantile_floor(
    df: DataFrame,
    keys: list[str],
    value: str,
    quantiles: Mapping[str, float],
    pages: int = PAGES,
    measure: Callable[[DataFrame], DataFrame] = lambda table: table,
) -> DataFrame:
    """Exact discrete quantiles by the index ``floor(q * (n - 1))`` of the sorted values.

    Equal values are counted first, so a group costs its distinct values and not its rows. The
    distinct values of a group are cut into about ``pages`` ranges at approximate quantiles, and only
    the ranges that hold a wanted rank are sorted, each on its own. The cuts only balance the work;
    the ranks come from exact counts. ``pages=0`` sorts all distinct values of a group together, for
    values that the calendar bounds (one per day).

    The cuts and the wanted ranges are one small row set per group. With many groups pass a
    ``measure`` that writes them as tables (``session.staged``): joins then know their size and can
    split a hot group.
    """
    hist = _histogram(df, keys, value)
    if pages <= 1:
        return _ranked(hist, keys, value).groupBy(*keys).agg(*_picks(quantiles, value))

    steps = [i / pages for i in range(1, pages)]
    # The filter holds for every row. It keeps the counts in this branch, so that Spark can reuse one
    # shuffled histogram for both branches.
    cuts = hist.filter(F.col("_n") > 0).groupBy(*keys).agg(
        F.percentile_approx(value, steps, max(1000, 10 * pages)).alias("_cuts")
    )
    paged = hist.join(measure(cuts), keys).select(
        *keys, value, "_n", F.size(F.filter("_cuts", lambda cut: cut < F.col(value))).alias("_page")
    )
    page_totals = paged.groupBy(*keys, "_page").agg(F.sum("_n").alias("_n"))
    spans = _ranked(page_totals, keys, "_page")
    wanted = [F.floor(F.lit(float(q)) * (F.col("_total") - 1)) for q in quantiles.values()]
    hit = F.lit(False)
    for index in wanted:
        hit = hit | ((F.col("_before") <= index) & (index < F.col("_upto")))
    spans = measure(spans.filter(hit).select(*keys, "_page", F.col("_before").alias("_offset"), "_total"))
    inside = W.partitionBy(*keys, "_page").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = (
        paged.join(spans, [*keys, "_page"])
        .withColumn("_upto", F.sum("_n").over(inside) + F.col("_offset"))
        .withColumn("_before", F.col("_upto") - F.col("_n"))
    )
    return ranked.groupBy(*keys).agg(*_picks(quantiles, value))


def borough_stats(t2: DataFrame) -> DataFrame:
    """Table T3a: mean, population standard deviation and quintile limits of daily rides per borough.

    A borough has one row per calendar day, so its distinct totals are few. Sums are exact integers;
    equal totals give a deviation of exactly zero.
    """
    ranked = _ranked(_histogram(t2, ["borough"], "total_rides"), ["borough"], "total_rides")
    x, n = F.col("total_rides").cast("decimal(20,0)"), F.col("_n").cast("decimal(20,0)")
    sums = ranked.groupBy("borough").agg(
        F.sum("_n").alias("n"),
        F.sum(x * n).alias("s1"),
        F.sum(x * x * n).alias("s2"),
        *_picks(DEMAND_QUANTILES, "total_rides"),
    )
    spread = F.expr("coalesce(try_subtract(try_multiply(s2, cast(n AS decimal(20,0))), try_multiply(s1, s1)), "
                    "raise_error('borough_stats: sums of total_rides beyond 38 digits'))")
    stats = sums.withColumns(
        {
            "mean": average_2dp(F.col("s1") * 100, F.col("n")),
            "stddev": F.round(F.sqrt(spread.cast("double")) / F.col("n"), 2).cast(MEASURE),
            **{q: F.col(q).cast(MEASURE) for q in DEMAND_QUANTILES},
        }
    )
    return stats.select(*STAGE_TABLES["T3a"].names)


def event_thresholds(t2: DataFrame) -> DataFrame:
    """Table T3c: the p33 and p66 limits of positive daily permit counts per borough."""
    counts = t2.select("borough", F.col("event_count").try_cast("bigint").alias("event_count"))
    return quantile_floor(counts.filter(F.col("event_count") > 0), ["borough"], "event_count", EVENT_QUANTILES, pages=0)
