"""The composed jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pedalgrid.operators import cells, clean, daily, enrich, geo, ledger, regress, stats
from pedalgrid.schemas import EVENTS_SOURCE, RIDE_DECISIONS, RIDES_SOURCE, STAGE_TABLES, WEATHER_SOURCE
from pedalgrid.session import staged
from pedalgrid.sources import files, readers, writers


@dataclass(frozen=True)
class Inputs:
    """Raw rides, unique station lookup, permits, and weather observations with their load order."""

    rides: DataFrame
    stations: DataFrame
    events: DataFrame
    weather: DataFrame
    weather_order: str = readers.LOAD_ORDER


def landed_paths(files: DataFrame, source: str) -> list[str]:
    """Newest path of each landed file of a source, in order; a list of files, as every read has one on the driver."""
    return sorted(r["path"] for r in ledger.current_paths(files, source).select("path").collect())


def read_landed(spark: SparkSession, files: DataFrame, stations: str, month: str | None = None, sample: bool = False) -> Inputs:
    """Inputs through the file ledger ``files``: of a file that was landed several times the newest counts, once."""
    return read_inputs(
        spark,
        landed_paths(files, RIDES_SOURCE),
        stations,
        landed_paths(files, EVENTS_SOURCE),
        landed_paths(files, WEATHER_SOURCE),
        month,
        sample,
    )


def read_inputs(
    spark: SparkSession,
    rides: str | list[str],
    stations: str,
    events: str | list[str],
    weather: str | list[str],
    month: str | None = None,
    sample: bool = False,
) -> Inputs:
    """Inputs from whole folders or listed files. Folders that hold a file twice are read twice; see ``read_landed``."""
    return Inputs(
        readers.read_rides(spark, rides, month, sample),
        readers.read_stations(spark, stations),
        readers.read_events(spark, events),
        readers.read_weather(spark, weather),
    )


def measured_lookup(stations: DataFrame) -> DataFrame:
    """The station lookup as a written table.

    Spark guesses the size of an aggregation from its input, and a guess that is too high would
    shuffle every ride. The size of the written table is known: Spark broadcasts it when that is
    under ``spark.sql.autoBroadcastJoinThreshold``, and only then.
    """
    return staged(clean.station_lookup(stations), "stations")


def daily_table(inputs: Inputs) -> DataFrame:
    """Table T2 as one lazy plan: rides are read once and never shuffled row by row."""
    rides = daily.daily_rides_from_kept(clean.kept_rides(inputs.rides), clean.station_lookup(inputs.stations))
    permits = daily.daily_events(clean.clean_events(inputs.events))
    return daily.join_daily(rides, daily.pivot_weather(inputs.weather, inputs.weather_order), permits)


@dataclass(frozen=True)
class DemandTables:
    t2: DataFrame
    t3a: DataFrame
    t3b: DataFrame
    t3c: DataFrame

    @property
    def w(self) -> DataFrame:
        return enrich.enrich(self.t2, self.t3a, self.t3b, self.t3c)


def demand_tables(inputs: Inputs) -> DemandTables:
    """Everything behind W. T2, days by boroughs, feeds four consumers and is staged once."""
    t2 = staged(daily_table(inputs), "T2")
    return DemandTables(t2, stats.borough_stats(t2), regress.fit_ols(t2), stats.event_thresholds(t2))


def daily_demand(inputs: Inputs) -> DataFrame:
    """Raw inputs to table W."""
    return demand_tables(inputs).w


def write_clean_rides(rides: DataFrame, stations: DataFrame, path: str, fmt: str = "parquet") -> dict[str, int]:
    """Write T1 and return the quality counters of the same pass over the input."""
    observation = Observation("ride_quality")
    tagged = clean.observe_quality(clean.tag_rides(rides), observation)
    t1 = clean.assign_borough(clean.project_kept(tagged), measured_lookup(stations))
    writers.write_stage(t1, "T1", path, fmt)
    return {label: observation.get[label] for label in RIDE_DECISIONS}


def write_counted_rides(rides: DataFrame, stations: DataFrame, path: str, fmt: str = "parquet") -> dict[str, int]:
    """Write T1 and return quality counters that belong to exactly the rows that were committed.

    One pass writes kept and dropped rides into a folder per decision, dropped ones without their columns. The
    counters are read from those files, so a task or stage that runs twice counts once. The folder of
    the kept rides then becomes T1 by a rename; it has to be on the same file system as ``path``.
    """
    spark = rides.sparkSession
    tagged = clean.assign_borough(clean.project_tagged(clean.tag_rides(rides)), measured_lookup(stations))
    parts = f"{path.rstrip('/')}.decisions"
    columns = STAGE_TABLES["T1"].names
    out = tagged.select(*columns, "decision") if fmt == "parquet" else tagged.select(writers.as_line(columns), "decision")
    out.write.mode("overwrite").partitionBy("decision").format(fmt).save(parts)
    layout = STAGE_TABLES["T1"] if fmt == "parquet" else "value string"
    schema = spark.createDataFrame([], layout).withColumn("decision", F.lit("")).schema
    counted = {r["decision"]: r["n"] for r in spark.read.schema(schema).format(fmt).load(parts).groupBy("decision").agg(F.count("*").alias("n")).collect()}
    if counted.get("kept"):
        files.move(spark, f"{parts}/decision=kept", path)
    else:
        writers.write_stage(spark.createDataFrame([], STAGE_TABLES["T1"]), "T1", path, fmt)
    files.remove(spark, parts)
    return {label: counted.get(label, 0) for label in RIDE_DECISIONS}


def run_stages(inputs: Inputs, out: str, fmt: str = "parquet") -> dict[str, int]:
    """All stage tables below ``out``, each written once and read back by its consumers."""
    spark = inputs.rides.sparkSession

    def put(df: DataFrame, name: str) -> DataFrame:
        writers.write_stage(df, name, f"{out}/{name}", fmt)
        return readers.read_stage(spark, name, f"{out}/{name}", fmt)

    counters = write_counted_rides(inputs.rides, inputs.stations, f"{out}/T1", fmt)
    t1 = readers.read_stage(spark, "T1", f"{out}/T1", fmt)
    t2_rides = put(daily.daily_rides(t1), "T2_rides")
    t2_events = put(daily.daily_events(clean.clean_events(inputs.events)), "T2_events")
    weather = daily.pivot_weather(inputs.weather, inputs.weather_order)
    t2 = put(daily.join_daily(t2_rides, weather, t2_events), "T2")
    t3a = put(stats.borough_stats(t2), "T3a")
    t3b = put(regress.fit_ols(t2), "T3b")
    t3c = put(stats.event_thresholds(t2), "T3c")
    put(enrich.enrich(t2, t3a, t3b, t3c), "W")
    return counters


def export_reports(spark: SparkSession, stages: str, out: str, fmt: str = "parquet") -> None:
    """The four report tables as headed, sorted tab-separated text."""
    for name in ("W", "T3a", "T3b", "T3c"):
        order = ["date", "borough"] if "date" in STAGE_TABLES[name].names else ["borough"]
        # One file each, as their readers expect.
        writers.export_tsv(readers.read_stage(spark, name, f"{stages}/{name}", fmt), f"{out}/{name}", order, single_file=True)


def build_stations(rides: DataFrame, polygons: DataFrame, order: str, band: float | None = None) -> DataFrame:
    """Station lookup with boroughs, from rides and borough polygons."""
    return geo.assign_stations(geo.unique_stations(rides, order), measured_bands(polygons, band))


@dataclass(frozen=True)
class StationBuild:
    """The written lookup, stations per borough, and how many lie outside all polygons."""

    stations: DataFrame
    per_borough: DataFrame
    outside: DataFrame


def write_station_lookup(rides: DataFrame, polygons: DataFrame, out: str, order: str = readers.LOAD_ORDER) -> StationBuild:
    """Build the lookup from all rides, write it as CSV, and count what was written."""
    spark = rides.sparkSession
    writers.write_stations(build_stations(rides, polygons, order), out)
    written = readers.read_stations(spark, out)
    return StationBuild(written, geo.borough_counts(written), geo.unmatched(written))


def measured_bands(polygons: DataFrame, band: float | None = None) -> geo.Bands:
    """Polygons by band as a written table, so that Spark broadcasts it by its real size or not at all.

    Without a ``band`` the height comes from the extent of the polygons, whatever their unit.
    """
    edges = geo.polygon_edges(polygons)
    height = band or geo.band_height(edges)
    return geo.Bands(staged(geo.banded_polygons(edges, height), "edges"), height)


def measured_cells(polygons: DataFrame, side: float | None = None) -> cells.Cells:
    """Polygons by cell as a written table; for many polygons, of which a band would hold too many edges."""
    edges = staged(geo.polygon_edges(polygons), "polygon_edges")
    size = side or cells.cell_size(edges)
    return cells.Cells(staged(cells.polygon_cells(edges, size), "cells"), size)


def plan_ingest(expected: DataFrame, landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files still to fetch, and per source how many are pending and skipped, with a TOTAL row."""
    pending = ledger.pending_files(expected, landed)
    todo = pending.select("source", F.lit(1).alias("new_files"), F.lit(0).alias("all_files"))
    every = expected.select("source", F.lit(0).alias("new_files"), F.lit(1).alias("all_files"))
    per_source = todo.unionByName(every).groupBy("source").agg(
        F.sum("new_files").alias("new_files"), (F.sum("all_files") - F.sum("new_files")).alias("skipped_files")
    )
    zero = F.lit(0).cast("bigint")
    log = per_source.select(
        "source", "new_files", "skipped_files", *[zero.alias(c) for c in ("bytes_pulled", "errors", "retries")]
    )
    return pending, ledger.ingest_summary(log)


@dataclass(frozen=True)
class Ingest:
    """What a landing run came to: files that were due, those whose size is wrong, the new ledger, totals per source, entries."""

    pending: DataFrame
    mismatched: DataFrame
    ledger: DataFrame
    summary: DataFrame
    entries: DataFrame


def run_ingest(expected: DataFrame, landed: DataFrame, arrived: DataFrame, source_sizes: DataFrame, records: DataFrame | None = None, fingerprints: DataFrame | None = None) -> Ingest:
    """One landing run as tables.

    ``landed`` is the ledger so far and ``arrived`` has the same columns: what was fetched, a file once per attempt.
    Only pending files count, each with its newest attempt. A file whose size is not that at the source is an error
    and stays pending. The others enter the ledger, with ``records(filename, record_count)`` and
    ``fingerprints(path, size_bytes, sha256)`` where there are any.
    """
    keys = ledger.KEY
    pending, _ = plan_ingest(expected, landed)
    due = arrived.join(pending.select(*keys).distinct(), keys, "left_semi")
    attempts = due.groupBy(*keys).agg(F.count("*").alias("attempts"))
    columns = landed.columns
    rest = [c for c in columns if c not in keys]
    order = F.struct("downloaded_at", "size_bytes", "path")
    newest = due.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("e")).select(*keys, "e.*")
    if fingerprints is not None:
        measured = fingerprints.select("path", F.col("size_bytes").alias("_size"), F.col("sha256").alias("_sha256"))
        newest = newest.join(measured, "path", "left").withColumns({"size_bytes": F.coalesce("_size", "size_bytes"), "sha256": F.coalesce("_sha256", "sha256")})
    if records is not None:
        counted = records.select("filename", F.col("record_count").alias("_records"))
        newest = newest.join(counted, "filename", "left").withColumn("record_count", F.coalesce("_records", "record_count"))
    newest = staged(newest.select(*columns), "arrived")
    mismatched = staged(ledger.reconcile_sizes(newest, source_sizes), "mismatched")
    good = newest.join(mismatched.select(*keys), keys, "left_anti").select(*columns)
    after = staged(ledger.upsert_ledger(landed, good), "ledger")

    zero = F.lit(0).cast("bigint")

    def rows(df: DataFrame, **counts) -> DataFrame:
        return df.select("source", *[counts.get(c, zero).cast("bigint").alias(c) for c in ledger.SUMMARY])

    one = F.lit(1)
    skipped = expected.join(pending.select(*keys), keys, "left_anti")
    log = (
        rows(good, new_files=one, bytes_pulled=F.col("size_bytes"))
        .unionByName(rows(skipped, skipped_files=one))
        .unionByName(rows(mismatched, errors=one))
        .unionByName(rows(attempts, retries=F.col("attempts") - 1))
    )
    return Ingest(pending, mismatched, after, ledger.ingest_summary(log), ledger.ledger_size(after))
