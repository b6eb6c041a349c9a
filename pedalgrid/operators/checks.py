"""Checks expressed as queries, previews and slices."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pedalgrid.functions.timeparse import month_bounds
from pedalgrid.session import scratch_path, staged

#: Buckets that two tables are compared in before any row moves.
BUCKETS = 4096


def compare_counts(a: DataFrame, b: DataFrame, label: str = "decision") -> DataFrame:
    """Two counter tables ``(label, n)`` side by side; missing labels count 0."""
    left, right = a.select(label, F.col("n").alias("n_a")), b.select(label, F.col("n").alias("n_b"))
    both = left.join(right, label, "full_outer")
    n_a, n_b = F.coalesce("n_a", F.lit(0)), F.coalesce("n_b", F.lit(0))
    return both.select(label, n_a.alias("n_a"), n_b.alias("n_b"), (n_a - n_b).alias("diff"))


def compare_tables(a: DataFrame, b: DataFrame) -> DataFrame:
    """Row counts of two tables and how many rows, duplicates counted, only one of them has.

    One shuffle of the distinct rows; equal rows are combined before it.
    """
    columns = a.columns
    signed = a.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    per_row = signed.groupBy(*columns).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    surplus = F.col("_a") - F.col("_b")
    zero = F.lit(0)
    totals = per_row.agg(
        F.sum("_a").alias("rows_a"),
        F.sum("_b").alias("rows_b"),
        F.sum(F.greatest(surplus, zero)).alias("only_a"),
        F.sum(F.greatest(-surplus, zero)).alias("only_b"),
    )
    return totals.select(*[F.coalesce(c, zero).cast("bigint").alias(c) for c in totals.columns])


def _hashable(df: DataFrame) -> list[Column]:
    """All columns, so that rows hash alike exactly if grouping takes them for equal: with nulls marked, and one zero."""
    parts = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("double", "float"):
            value = F.when(value == 0, F.lit(0.0)).otherwise(value)
        parts += [value.isNull(), value]
    return parts


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    parts = _hashable(df)
    return df.withColumns({"_h1": F.xxhash64(*parts), "_h2": F.xxhash64(F.lit("second"), *reversed(parts))}).withColumn(
        "_bucket", F.pmod("_h1", F.lit(buckets))
    )


def multiset_fingerprint(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n, s1 .. s4``: rows per bucket and the sums of the halves of two independent 64-bit hashes.

    Order does not matter and repeated rows count. Each task sends one row per bucket. Halves are summed so that
    no sum overflows below two thousand million rows a bucket.
    """
    low = F.lit(0xFFFFFFFF)
    halves = [F.col("_h1").bitwiseAND(low), F.shiftrightunsigned("_h1", 32), F.col("_h2").bitwiseAND(low), F.shiftrightunsigned("_h2", 32)]
    sums = [F.sum(h).alias(f"s{k}") for k, h in enumerate(halves, 1)]
    return _bucketed(df, buckets).groupBy(F.col("_bucket").alias("bucket")).agg(F.count("*").alias("n"), *sums)


def compare_by_fingerprint(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The result of ``compare_tables`` without moving the rows of buckets that agree.

    First both tables are read once and only their fingerprints meet. Rows of buckets that differ are then read
    again and compared; if none differ, no row ever leaves its task. A difference goes unseen only if
    both 64-bit sums and the count of its bucket agree by chance.
    """
    b = b.select(*a.columns)
    sums = ["n", "s1", "s2", "s3", "s4"]
    left, right = (multiset_fingerprint(df, buckets).select("bucket", F.struct(*sums).alias(side)) for df, side in ((a, "a"), (b, "b")))
    both = staged(left.join(right, "bucket", "full_outer"), "fingerprints")
    zero = F.lit(0)
    agree = both.where(F.col("a").eqNullSafe(F.col("b"))).agg(F.coalesce(F.sum("a.n"), zero).cast("bigint").alias("n"))
    equal = agree.select(F.col("n").alias("rows_a"), F.col("n").alias("rows_b"), *[zero.cast("bigint").alias(c) for c in ("only_a", "only_b")])
    differing = both.where(~F.col("a").eqNullSafe(F.col("b"))).select(F.col("bucket").alias("_bucket"))
    if differing.isEmpty():
        return equal
    # At most as many rows as there are buckets.
    some = [_bucketed(df, buckets).join(differing, "_bucket", "left_semi").select(*a.columns) for df in (a, b)]
    parts = equal.unionByName(compare_tables(*some))
    return parts.agg(*[F.sum(c).cast("bigint").alias(c) for c in parts.columns])


def spot_check(w: DataFrame, date: str, borough: str) -> DataFrame:
    return w.filter((F.col("date") == F.lit(date).cast("date")) & (F.col("borough") == borough))


def preview(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    return df.orderBy(*order).limit(n)


def check_grain(df: DataFrame, *keys: str) -> DataFrame:
    """Rows, distinct values of each key, and keys that occur more than once."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.count(F.when(F.col("_n") > 1, 1)).alias("repeated_keys"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def month_slice(df: DataFrame, ts: str, yyyymm: str) -> DataFrame:
    """Rows from the first instant of a month up to, not including, the next month."""
    first, last = month_bounds(F.lit(yyyymm))
    kind = df.schema[ts].dataType
    return df.filter((F.col(ts) >= first.cast(kind)) & (F.col(ts) < F.date_add(last, 1).cast(kind)))


@dataclass(frozen=True)
class PageIndex:
    """A listing written in order, and where each of its files starts."""

    order: tuple[str, ...]
    schema: StructType
    files: tuple[tuple[str, int, int], ...]  # path, rows before it, its rows
    spark: SparkSession

    @property
    def rows(self) -> int:
        return self.files[-1][1] + self.files[-1][2] if self.files else 0

    def page(self, offset: int, limit: int) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` of the listing; only the files that hold them are opened."""
        own = [f for f in self.files if f[1] < offset + limit and f[1] + f[2] > offset]
        if not own or limit <= 0:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*[path for path, _, _ in own])
        return rows.orderBy(*self.order).offset(max(0, offset - own[0][1])).limit(limit)


def page_index(df: DataFrame, order: list[str], rows_per_file: int = 100_000) -> PageIndex:
    """Write ``df`` range-sorted by ``order``, which must tell all rows apart, and count the rows of each file.

    The listing is sorted once; then any page, however deep, costs a file or two. One entry per file comes to the
    driver, as a file listing does.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "pages")
    df.orderBy(*order).write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    file = F.col("_metadata.file_path").alias("file")
    counted = written.groupBy(file).agg(F.min(F.struct(*order)).alias("first"), F.count("*").alias("n"))
    found, before = [], 0
    for row in counted.orderBy("first").collect():
        found.append((row["file"], before, row["n"]))
        before += row["n"]
    return PageIndex(tuple(order), df.schema, tuple(found), spark)


def page(df: DataFrame, order: list[str], limit: int, offset: int = 0, after: tuple | None = None) -> DataFrame:
    """One page of an ordered listing.

    ``offset`` suits the first pages. Deep listings pass ``after``, the order values of the last row
    seen, so that a page costs its own rows and not those before it.
    """
    if after is not None:
        beyond = F.lit(False)
        tied = F.lit(True)
        for name, value in zip(order, after, strict=True):
            beyond = beyond | (tied & (F.col(name) > F.lit(value)))
            tied = tied & (F.col(name) == F.lit(value))
        df = df.filter(beyond)
    return df.orderBy(*order).offset(offset).limit(limit)
