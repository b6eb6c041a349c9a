"""Sinks. Stage tables are Parquet between jobs; tab-separated text is offered for exchange."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalgrid.schemas import LEDGER, STAGE_TABLES, STATIONS
from pedalgrid.sources import files

LEDGER_VERSION = 1


def _as_text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def as_line(columns: list[str]) -> Column:
    """The columns as one tab-separated line, ``value``."""
    return F.concat_ws("\t", *[_as_text(c) for c in columns]).alias("value")


def write_stage(df: DataFrame, name: str, path: str, fmt: str = "parquet") -> None:
    """Overwrite a stage table in its contract order; text rows are unquoted, missing values empty."""
    columns = STAGE_TABLES[name].names
    out = df.select(*columns)
    if fmt == "parquet":
        out.write.mode("overwrite").parquet(path)
    else:
        out.select(as_line(columns)).write.mode("overwrite").text(path)


def write_rides(df: DataFrame, path: str, *by: str) -> None:
    """Ride rows as quoted CSV parts with a header, the layout ``read_rides`` takes; below a folder per value of ``by``."""
    df.write.mode("overwrite").option("header", "true").option("escape", '"').option("emptyValue", "").partitionBy(*by).csv(path)


def export_tsv(df: DataFrame, path: str, order: list[str], single_file: bool = False) -> None:
    """Report table as range-sorted parts, each with a header line; the same layout at any size.

    ``single_file`` makes one file with one header of them: the parts are written without headers by as many tasks as
    ever, and the file system joins them in order.
    """
    rows = df.orderBy(*order).write.mode("overwrite").option("sep", "\t").option("quote", "\u0000").option("emptyValue", "")
    if not single_file:
        rows.option("header", "true").csv(path)
        return
    spark, parts = df.sparkSession, f"{path.rstrip('/')}.parts"
    rows.option("header", "false").csv(parts)
    files.remove(spark, path)
    files.join_parts(spark, "\t".join(df.columns) + "\n", files.part_files(spark, parts), f"{path.rstrip('/')}/part-00000.csv")
    files.remove(spark, parts)


def write_stations(df: DataFrame, path: str) -> None:
    """Station lookup CSV with coordinates to six decimals."""
    out = df.select(
        "start_station_id",
        "station_name",
        F.format_string("%.6f", "latitude").alias("latitude"),
        F.format_string("%.6f", "longitude").alias("longitude"),
        "borough",
    ).select(*STATIONS.names)
    out.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def write_ledger(df: DataFrame, root: str, fmt: str = "parquet") -> str:
    """Save the ledger as a new snapshot below ``root``, sorted by key; returns the snapshot's folder.

    Earlier snapshots stay, so ``df`` may itself come from ``root``; ``read_ledger`` takes the newest.
    """
    moment = datetime.now(timezone.utc)
    path = f"{root}/snapshot={moment:%Y%m%dT%H%M%S%fZ}"
    out = df.select(
        *LEDGER.names, F.lit(LEDGER_VERSION).alias("version"), F.lit(f"{moment:%Y-%m-%dT%H:%M:%SZ}").alias("last_updated")
    )
    out.orderBy("source", "filename").write.format(fmt).save(path)
    return path
