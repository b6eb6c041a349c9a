"""Row quality and cleaning of rides and permits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pedalgrid.functions.timeparse import minutes_2dp, ride_date, with_duration_ms, with_iso_date
from pedalgrid.schemas import (
    CORRUPT,
    EVENT_DECISIONS,
    MAX_RIDE_MINUTES,
    MIN_RIDE_MINUTES,
    OTHER_BOROUGH,
    RIDE_DECISIONS,
    STAGE_TABLES,
)
from pedalgrid.sources.readers import short_row

_MS_PER_MINUTE = 60_000


def _blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def tag_rides(rides: DataFrame) -> DataFrame:
    """Every ride with ``duration_ms`` and the first rule it fails, or ``kept``."""
    short = short_row("member_casual", 13) if CORRUPT in rides.columns else F.lit(False)
    millis = F.col("duration_ms")
    decision = (
        F.when(short, "dropped_short_row")
        .when(_blank(F.col("start_station_id")), "dropped_no_station")
        .when(millis.isNull(), "dropped_bad_timestamp")
        .when(millis < MIN_RIDE_MINUTES * _MS_PER_MINUTE, "dropped_too_short")
        .when(millis > MAX_RIDE_MINUTES * _MS_PER_MINUTE, "dropped_too_long")
        .otherwise("kept")
    )
    return with_duration_ms(rides, "started_at", "ended_at").withColumn("decision", decision)


def kept_rides(rides: DataFrame) -> DataFrame:
    """Rides that pass every rule, before the borough is known: date, trimmed texts, minutes."""
    return project_kept(tag_rides(rides))


def project_kept(tagged: DataFrame, *more: str) -> DataFrame:
    """The kept rides, with the columns ``more`` as they are."""
    return tagged.filter(F.col("decision") == "kept").select(
        F.trim("ride_id").alias("ride_id"),
        ride_date(F.trim("started_at")).cast("date").alias("date"),
        F.trim("rideable_type").alias("rideable_type"),
        F.trim("member_casual").alias("member_casual"),
        minutes_2dp(F.col("duration_ms")).alias("ride_duration_min"),
        F.trim("start_station_id").alias("start_station_id"),
        *more,
    )


def project_tagged(tagged: DataFrame) -> DataFrame:
    """Every ride with its decision, its T1 columns where it is kept and none where it is dropped."""
    kept = F.col("decision") == "kept"
    all_kept = tagged.withColumn("_decision", F.col("decision")).withColumn("decision", F.lit("kept"))
    columns = project_kept(all_kept, "_decision").withColumnRenamed("_decision", "decision")
    return columns.select(*[F.when(kept, F.col(c)).alias(c) for c in columns.columns if c != "decision"], "decision")


def station_lookup(stations: DataFrame) -> DataFrame:
    """One borough per station id; if ids repeat, the alphabetically last borough stands.

    ``read_stations`` has already applied last-row-wins, this only guards the join against fan-out.
    """
    return stations.groupBy(F.trim("start_station_id").alias("start_station_id")).agg(F.max("borough").alias("borough"))


def assign_borough(rides: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left join on the station id, ``Other`` for unknown ones.

    There is no broadcast hint: Spark broadcasts the lookup when its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where adaptive execution splits
    a hot station over several tasks. Both need ``lookup`` to be a written table, as
    ``plans.demand.measured_lookup`` makes it: an aggregation has no known size, and one between
    shuffle and join rules the splitting out.
    """
    joined = rides.join(lookup, "start_station_id", "left")
    return joined.withColumn("borough", F.coalesce("borough", F.lit(OTHER_BOROUGH)))


def clean_rides(rides: DataFrame, lookup: DataFrame) -> DataFrame:
    """Raw rides to table T1."""
    return assign_borough(kept_rides(rides), lookup).select(*STAGE_TABLES["T1"].names)


def tag_events(events: DataFrame) -> DataFrame:
    """Every permit with its local ``date``, trimmed borough and type, and a decision."""
    short = short_row("event_borough", 7) if CORRUPT in events.columns else F.lit(False)
    decision = (
        F.when(short, "dropped_short_row")
        .when(_blank(F.col("start_date_time")) | (F.col("borough") == ""), "dropped_empty")
        .when(F.col("date").isNull(), "dropped_bad_timestamp")
        .otherwise("kept")
    )
    trimmed = events.selectExpr("*", "trim(coalesce(event_borough, '')) AS borough", "trim(coalesce(event_type, '')) AS type")
    return with_iso_date(trimmed, "start_date_time").withColumn("decision", decision)


def clean_events(events: DataFrame, *more: str) -> DataFrame:
    return tag_events(events).filter(F.col("decision") == "kept").select("date", "borough", "type", *more)


def _label_counts(labels) -> list[Column]:
    return [F.count(F.when(F.col("decision") == label, 1)).alias(label) for label in labels]


def quality_counts(tagged: DataFrame, labels=RIDE_DECISIONS) -> DataFrame:
    """Rows per decision, zero for labels that do not occur; each task sends one row of counters."""
    return tagged.agg(*_label_counts(labels)).unpivot([], list(labels), "decision", "n")


def observe_quality(tagged: DataFrame, observation: Observation, labels=RIDE_DECISIONS) -> DataFrame:
    """Count the decisions while the rows flow to a sink, so that the input is read once."""
    return tagged.observe(observation, *_label_counts(labels))


def event_quality_counts(events: DataFrame) -> DataFrame:
    return quality_counts(tag_events(events), EVENT_DECISIONS)
