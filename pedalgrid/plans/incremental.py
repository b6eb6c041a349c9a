"""Incremental run: only the periods (months, unless told otherwise) whose files changed are computed again.

T1, daily rides, daily permits, weather and the regression's sums are kept below one folder, partitioned
by period. A lineage table says which periods each landed file had rows for, and in which version it was read.
A run compares the ledger with the lineage, reads the files that are new or changed, and from the lineage
knows which other files share a period with them. Those periods are overwritten; no other file is opened
or written. The lineage is committed last: a run that breaks off is done again with the same outcome.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalgrid.operators import checks, clean, daily, enrich, regress, stats
from pedalgrid.plans.demand import measured_lookup
from pedalgrid.schemas import EVENTS_SOURCE, RIDES_SOURCE, STAGE_TABLES, STATIONS_SOURCE, WEATHER_SOURCE
from pedalgrid.session import staged
from pedalgrid.sources import readers, snapshots

MONTHS = "yyyyMM"
LINEAGE = T.StructType([T.StructField(c, T.StringType()) for c in ("source", "filename", "version", "period")])
_LOOKUP = "station_lookup"


@dataclass(frozen=True)
class Refreshed:
    """Periods that were written, per table, and the enriched table over all periods."""

    w: DataFrame
    periods: dict[str, list[str]] = field(default_factory=dict)


def _bare(path: Column) -> Column:
    """A path without scheme and host, as ledgers and file listings spell them differently."""
    return F.regexp_replace(path, r"^[A-Za-z0-9]+:(//[^/]*)?", "")


def _landed(files: DataFrame) -> DataFrame:
    """``source, filename, path, version`` of the newest landing of each file."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("path", "size_bytes", "sha256", "downloaded_at")]
    newest = F.struct("run_date", "downloaded_at", "path")
    picked = files.groupBy("source", "filename").agg(F.max_by(F.struct("path", F.concat_ws("|", *text).alias("version")), newest).alias("f"))
    return picked.select("source", "filename", "f.path", "f.version")


def _stations_version(lookup: DataFrame) -> str:
    """Changes when any station changes its borough."""
    row = checks.multiset_fingerprint(lookup, buckets=1).first()
    return "-".join(str(v) for v in row) if row else "empty"


class _Source:
    """One kind of files: which of its periods are to be written, and their rows."""

    def __init__(self, spark: SparkSession, name: str, landed: DataFrame, lineage: DataFrame, rows: Callable[[list[str]], DataFrame], period: str, all_periods: bool) -> None:
        self.name, self.period = name, period
        landed, lineage = landed.where(F.col("source") == name), lineage.where(F.col("source") == name)
        version = ["source", "filename", "version"]
        changed = landed.join(lineage, version, "left_anti")
        stale = lineage.join(landed, version, "left_anti")
        paths = [r["path"] for r in changed.select("path").collect()]
        self.fresh = staged(self._with_period(rows(paths)), name) if paths else None
        touched = lineage if all_periods else stale
        found = touched.select("period")
        if self.fresh is not None:
            found = found.unionByName(self.fresh.select("period"))
        # Periods are calendar units: a short list, however many rows there are.
        self.touched = sorted(r["period"] for r in found.where(F.col("period").isNotNull()).distinct().collect())
        kept = lineage.join(landed, version, "left_semi")
        neighbours = kept.where(F.col("period").isin(self.touched)).join(landed, version).select("path").distinct()
        others = [r["path"] for r in neighbours.collect()] if self.touched else []
        self.rows = self.fresh
        if others:
            again = self._with_period(rows(others))
            again = again.where(F.col("period").isin(self.touched))
            self.rows = again if self.fresh is None else self.fresh.unionByName(again)
        periods = kept.select(*LINEAGE.names)
        if self.fresh is not None:
            seen = self.fresh.select(_bare(F.col("_file")).alias("_at"), "period").distinct()
            at = changed.withColumn("_at", _bare(F.col("path")))
            # A file without usable rows has one entry without a period, so that it is not read again.
            periods = periods.unionByName(at.join(seen, "_at", "left").select(*LINEAGE.names))
        self.lineage = periods

    def _with_period(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("period", F.date_format("date", self.period))

    def select(self) -> DataFrame | None:
        return None if self.rows is None or not self.touched else self.rows.drop("_file")


def _file() -> Column:
    return F.col("_metadata.file_path").alias("_file")


def _overwrite(df: DataFrame, path: str) -> None:
    """Replace the periods that ``df`` has; a large period is written by several tasks, small ones by one."""
    spread = df.hint("rebalance", "period")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)


def _read(spark: SparkSession, path: str, schema: T.StructType, periods: list[str]) -> DataFrame:
    """Rows of the given periods; one whose files are gone is left behind on disk and not read."""
    if not periods:
        return spark.createDataFrame([], schema).withColumn("period", F.lit(None).cast("string"))
    kept = T.StructType([*schema.fields, T.StructField("period", T.StringType())])
    return spark.read.schema(kept).parquet(path).where(F.col("period").isin(periods))


_PIVOTED = T.StructType([T.StructField("date", T.DateType())] + [T.StructField(c, T.DoubleType()) for c in ("tmax", "tmin", "prcp", "snow")])


def refresh(spark: SparkSession, files: DataFrame, stations: DataFrame, out: str, period: str = MONTHS, weather_pattern: str = "*.json") -> Refreshed:
    """Bring the tables below ``out`` up to date with the ledger ``files`` and return the enriched table.

    The first run computes everything. A file counts as changed if its newest landing has another path, size, hash or
    time than the one that was read. A changed station lookup touches all periods of the rides. Periods whose
    files are gone are no longer read. ``period`` is a date pattern; it must stay the same for one folder.
    """
    root = out.rstrip("/")
    landed, lineage = staged(_landed(files), "landed"), staged(snapshots.read(spark, f"{root}/lineage", LINEAGE), "lineage")
    lookup = measured_lookup(stations)
    version = _stations_version(lookup)
    before = [r["version"] for r in lineage.where(F.col("source") == STATIONS_SOURCE).select("version").collect()]

    def rides(paths: list[str]) -> DataFrame:
        return clean.project_kept(clean.tag_rides(readers.read_rides(spark, paths).select("*", _file())), "_file")

    def permits(paths: list[str]) -> DataFrame:
        return clean.clean_events(readers.read_events(spark, paths).select("*", _file()), "_file")

    def weather(paths: list[str]) -> DataFrame:
        return readers.read_weather(spark, paths, weather_pattern).withColumn("_file", F.col(f"{readers.LOAD_ORDER}.file"))

    sources = {
        name: _Source(spark, name, landed, lineage, rows, period, name == RIDES_SOURCE and before not in ([], [version]))
        for name, rows in ((RIDES_SOURCE, rides), (EVENTS_SOURCE, permits), (WEATHER_SOURCE, weather))
    }
    own = spark.createDataFrame([(STATIONS_SOURCE, _LOOKUP, version, None)], LINEAGE)
    # Joins of staged tables and of rows that are about to be overwritten: written before anything changes.
    after = own
    for source in sources.values():
        after = after.unionByName(source.lineage)
    after = staged(after, "new_lineage")
    live = {name: sorted(r["period"] for r in after.where((F.col("source") == name) & F.col("period").isNotNull()).select("period").distinct().collect()) for name in sources}

    kept = sources[RIDES_SOURCE].select()
    if kept is not None:
        _overwrite(clean.assign_borough(kept, lookup).select(*STAGE_TABLES["T1"].names, "period"), f"{root}/T1")
        t1 = _read(spark, f"{root}/T1", STAGE_TABLES["T1"], [p for p in sources[RIDES_SOURCE].touched if p in live[RIDES_SOURCE]])
        _overwrite(daily.daily_rides(t1).withColumn("period", F.date_format("date", period)), f"{root}/T2_rides")
    events = sources[EVENTS_SOURCE].select()
    if events is not None:
        _overwrite(daily.daily_events(events).withColumn("period", F.date_format("date", period)), f"{root}/T2_events")
    observed = sources[WEATHER_SOURCE].select()
    if observed is not None:
        pivoted = daily.pivot_weather(observed).select("date", *[F.col(c).cast("double") for c in _PIVOTED.names[1:]])
        _overwrite(pivoted.withColumn("period", F.date_format("date", period)), f"{root}/weather")

    def days(periods: list[str]) -> DataFrame:
        def of(name: str, table: str, schema: T.StructType) -> DataFrame:
            return _read(spark, f"{root}/{table}", schema, [p for p in periods if p in live[name]]).drop("period")

        rides_ = of(RIDES_SOURCE, "T2_rides", STAGE_TABLES["T2_rides"])
        return daily.join_daily(rides_, of(WEATHER_SOURCE, "weather", _PIVOTED), of(EVENTS_SOURCE, "T2_events", STAGE_TABLES["T2_events"]))

    # The sums hold rides and weather: they change where either does.
    summed = sorted({*sources[RIDES_SOURCE].touched, *sources[WEATHER_SOURCE].touched} & {*live[RIDES_SOURCE]})
    state = regress.period_moments(days(summed).withColumn("period", F.date_format("date", period)), "period")
    if summed:
        # A period may have rides and no temperature, then it has no sums: its former ones are replaced by none.
        empty = spark.createDataFrame([(p,) for p in summed], "period string").join(state.select("period").distinct(), "period", "left_anti")
        none = empty.select("period", F.lit("").alias("borough"), *[F.lit(0).cast(state.schema[c].dataType).alias(c) for c in regress.MOMENTS])
        _overwrite(staged(state.unionByName(none), "moments"), f"{root}/moments")
    snapshots.commit(spark, f"{root}/lineage", LINEAGE, lambda _: after)

    fields = [f for f in state.schema.fields if f.name != "period"]
    kept_state = _read(spark, f"{root}/moments", T.StructType(fields), live[RIDES_SOURCE])
    t2 = staged(days(sorted({*live[RIDES_SOURCE], *live[WEATHER_SOURCE], *live[EVENTS_SOURCE]})), "T2")
    t3b = regress.fit_moments(regress.combined_moments(kept_state))
    w = enrich.enrich(t2, stats.borough_stats(t2), t3b, stats.event_thresholds(t2))
    touched = {name: source.touched for name, source in sources.items()}
    return Refreshed(w, touched | {"moments": summed})
