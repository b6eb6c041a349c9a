"""Incremental landing: which files are expected, landed, pending, and what a run did."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Mapping
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalgrid.functions.timeparse import month_bounds
from pedalgrid.schemas import FILE_PATTERNS, FIRST_MONTH, LAST_MONTH, LEDGER
from pedalgrid.sources import readers, snapshots

KEY = ["source", "filename"]
SUMMARY = ("new_files", "skipped_files", "bytes_pulled", "errors", "retries")
#: Bytes of a file that a task holds, and tasks that files are dealt to at most.
BLOCK_BYTES = 8 << 20
MOST_TASKS = 10_000
RUN_LOG = "source string, " + ", ".join(f"{c} bigint" for c in SUMMARY)


def month_range(spark: SparkSession, first: str = FIRST_MONTH, last: str = LAST_MONTH) -> DataFrame:
    """The default period as one row with its first and last ``yyyyMM`` month."""
    return spark.createDataFrame([(first, last)], "first string, last string")


def expected_files(span: DataFrame, patterns: Mapping[str, str] = FILE_PATTERNS) -> DataFrame:
    """One row per month of ``span(first, last)`` and source, with file name and month bounds."""
    start, _ = month_bounds(F.col("first"))
    stop, _ = month_bounds(F.col("last"))
    months = span.select(F.explode(F.sequence(start, stop, F.expr("interval 1 month"))).alias("month_start"))
    months = months.withColumn("month", F.date_format("month_start", "yyyyMM"))
    names = F.array(
        *[F.struct(F.lit(s).alias("source"), F.format_string(p, "month").alias("filename")) for s, p in patterns.items()]
    )
    return months.select(
        "month", "month_start", F.last_day("month_start").alias("month_end"), F.inline(names).alias("source", "filename")
    ).select("source", "filename", "month", "month_start", "month_end")


def pending_files(expected: DataFrame, ledger: DataFrame) -> DataFrame:
    """Expected files to fetch: absent, landed empty, or landed from another dataset.

    An entry without a dataset id counts as landed whatever is expected now.
    """
    landed = ledger.filter(F.col("size_bytes") > 0).select(*KEY, F.col("dataset_id").alias("_landed_id"))
    if "dataset_id" not in expected.columns:
        return expected.join(landed, KEY, "left_anti")
    e, l = expected.alias("e"), landed.alias("l")
    wanted = F.col("e.dataset_id")
    same = wanted.isNull() | F.coalesce(F.nullif("l._landed_id", F.lit("")), wanted).eqNullSafe(wanted)
    keys = (F.col("e.source") == F.col("l.source")) & (F.col("e.filename") == F.col("l.filename"))
    return e.join(l, keys & same, "left_anti")


def upsert_ledger(old: DataFrame, new: DataFrame, order: str = "downloaded_at") -> DataFrame:
    """Ledger after a run: one entry per (source, filename), that of the run if it has one.

    Among several entries of the run the newest by ``order`` stands, of equally new ones the larger
    file, then the last path.
    """
    columns = old.columns
    rest = [c for c in columns if c not in KEY]
    newest = new.groupBy(*KEY).agg(F.max_by(F.struct(*rest), F.struct(order, "size_bytes", "path")).alias("entry")).select(*KEY, "entry.*")
    return old.join(newest, KEY, "left_anti").select(*columns).unionByName(newest.select(*columns))


def commit_run(spark: SparkSession, root: str, run: DataFrame) -> int:
    """Add the entries of a run to the ledger below ``root`` as its next version; several runs may do so at once."""
    return snapshots.commit(spark, root, LEDGER, lambda old: upsert_ledger(old, run))


def committed_ledger(spark: SparkSession, root: str) -> DataFrame:
    """The newest committed version of the ledger, empty if there is none."""
    return snapshots.read(spark, root, LEDGER)


def current_paths(ledger: DataFrame, source: str) -> DataFrame:
    """Newest landed path of each file, so that a month landed twice is read once; of one day the latest, then the last path."""
    newest = F.struct("run_date", "downloaded_at", "path")
    return ledger.filter(F.col("source") == source).groupBy(*KEY).agg(F.max_by("path", newest).alias("path"))


def reconcile_sizes(landed: DataFrame, source: DataFrame) -> DataFrame:
    """Files whose landed size differs from the size at the source."""
    theirs = source.select(*KEY, F.col("size_bytes").alias("source_bytes"))
    return landed.join(theirs, KEY).filter(F.col("size_bytes") != F.col("source_bytes"))


def fingerprint(df: DataFrame, content: str) -> DataFrame:
    """Size in bytes and SHA-256 of a text or binary column, next to the other columns."""
    rest = [c for c in df.columns if c != content]
    return df.select(
        *rest, F.octet_length(content).cast("bigint").alias("size_bytes"), F.sha2(F.col(content).cast("binary"), 256).alias("sha256")
    )


def fingerprint_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, filename, size_bytes, sha256`` of the files below ``path``, however large.

    Only names are listed by the driver. A task opens its files by path and reads them block by block, so it
    holds ``BLOCK_BYTES`` of a file. The file system must be one that pyarrow opens (local, HDFS, S3 and others). Empty
    files have no rows: Spark's readers pass them over.
    """
    listed = readers.list_files(spark, path).select("path", "filename")
    # A file is the unit of work, whatever its size: files are dealt out evenly and no task has many.
    tasks = max(1, min(listed.count(), MOST_TASKS))
    return listed.repartition(tasks, "path").mapInArrow(_fingerprints, "path string, filename string, size_bytes bigint, sha256 string")


def _uri(path: str) -> str:
    """A path as Spark lists it, with plain characters and maybe no host, as a standard URI."""
    scheme, host, rest = re.fullmatch(r"([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/]*)?(.*)", path, re.DOTALL).groups()
    return f"{scheme or 'file:'}{host or '//'}{quote(rest)}"


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests = [], []
        for name in batch["path"].to_pylist():
            system, at = FileSystem.from_uri(_uri(name))
            digest, size = hashlib.sha256(), 0
            with system.open_input_stream(at, compression=None) as stream:
                while block := stream.read(BLOCK_BYTES):
                    digest.update(block)
                    size += len(block)
            sizes.append(size)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch["path"], batch["filename"], pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], ["path", "filename", "size_bytes", "sha256"])


def records_per_file(df: DataFrame, file: str = "_metadata.file_name") -> DataFrame:
    return df.groupBy(F.col(file).alias("filename")).agg(F.count("*").alias("record_count"))


def ledger_size(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.count("*").alias("entries"))


def ingest_summary(log: DataFrame) -> DataFrame:
    """Totals per source and a TOTAL row, which is there even when nothing ran."""
    per_source = log.groupBy("source").agg(*[F.sum(c).alias(c) for c in SUMMARY])
    total = per_source.agg(*[F.sum(c).cast("bigint").alias(c) for c in SUMMARY])
    rows = per_source.unionByName(total.select(F.lit("TOTAL").alias("source"), *SUMMARY))
    return rows.select("source", *[F.coalesce(c, F.lit(0)).alias(c) for c in SUMMARY])


def run_sources(spark: SparkSession, jobs: Mapping[str, Callable[[], Mapping[str, int]]]) -> DataFrame:
    """Run one landing job per source and log its counts; a failing source does not stop the others."""
    rows = []
    for source, job in jobs.items():
        try:
            done = dict(job())
        except Exception:  # the log row is the report
            done = {"errors": 1}
        rows.append((source, *[int(done.get(c, 0)) for c in SUMMARY]))
    return spark.createDataFrame(rows, RUN_LOG)
