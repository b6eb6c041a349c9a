"""Daily grain: rides, permits, weather, and their join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalgrid.functions.measures import average_2dp, depth_or_zero, temp_avg
from pedalgrid.schemas import MINUTES, OTHER_BOROUGH, STAGE_TABLES, WEATHER_DATATYPES
from pedalgrid.sources.readers import LOAD_ORDER

_PARTIALS = ("total_rides", "member_rides", "minutes")


def _finish_daily(sums: DataFrame) -> DataFrame:
    average = average_2dp(F.col("minutes") * 100, F.col("total_rides")).cast(MINUTES)
    return sums.withColumn("avg_duration_min", average).select(*STAGE_TABLES["T2_rides"].names)


def _ride_sums(rides: DataFrame, *keys: str) -> DataFrame:
    return rides.groupBy(*keys).agg(
        F.count("*").alias("total_rides"),
        F.count(F.when(F.col("member_casual") == "member", 1)).alias("member_rides"),
        F.sum("ride_duration_min").alias("minutes"),
    )


def daily_rides(t1: DataFrame) -> DataFrame:
    """Rides, member rides and mean minutes per date and borough."""
    return _finish_daily(_ride_sums(t1, "date", "borough"))


def daily_rides_from_kept(kept: DataFrame, lookup: DataFrame) -> DataFrame:
    """The same table straight from cleaned rides, without a row-level T1.

    Rides are first summed per date and station, so the borough join sees days by stations rather
    than rides, and a station with a third of all rides is one row a day before any shuffle.
    """
    by_station = _ride_sums(kept, "date", "start_station_id")
    named = by_station.join(lookup, "start_station_id", "left").withColumn(
        "borough", F.coalesce("borough", F.lit(OTHER_BOROUGH))
    )
    sums = named.groupBy("date", "borough").agg(
        *[F.sum(c).cast("decimal(38,2)" if c == "minutes" else "bigint").alias(c) for c in _PARTIALS]
    )
    return _finish_daily(sums)


def daily_events(cleaned: DataFrame) -> DataFrame:
    """Permits and distinct non-blank types (sorted, ``;``-joined) per date and borough.

    Counting per type first keeps the large pass a hash aggregation with a map-side combine; only
    distinct types reach the second step.
    """
    per_type = cleaned.groupBy("date", "borough", "type").agg(F.count("*").alias("n"))
    types = F.array_sort(F.collect_list(F.when(F.col("type") != "", F.col("type"))))
    return per_type.groupBy("date", "borough").agg(
        F.sum("n").alias("event_count"), F.array_join(types, ";").alias("event_types")
    )


def pivot_weather(rows: DataFrame, order: str = LOAD_ORDER) -> DataFrame:
    """Long observations to one row per date; the latest value by ``order`` wins, other datatypes are ignored.

    ``order`` must be unique per observation.
    """
    known = rows.filter(F.col("datatype").isin(*WEATHER_DATATYPES) & F.col("date").isNotNull())
    # Grouping by datatype as well keeps one value and one order per row in the buffer.
    newest = known.groupBy("date", "datatype").agg(F.max_by("value", order).alias("value"))
    return newest.groupBy("date").agg(
        *[F.max(F.when(F.col("datatype") == t, F.col("value"))).alias(t.lower()) for t in WEATHER_DATATYPES]
    )


def daily_weather(pivoted: DataFrame) -> DataFrame:
    """Temperature, rain and snow per date as stored in T2."""
    return pivoted.select(
        "date",
        temp_avg(F.col("tmax"), F.col("tmin")).alias("temp"),
        depth_or_zero(F.col("prcp")).alias("precip"),
        depth_or_zero(F.col("snow")).alias("snow"),
    )


def join_daily(t2_rides: DataFrame, pivoted: DataFrame, t2_events: DataFrame) -> DataFrame:
    """Table T2: every (date, borough) with rides, its weather and its permits."""
    joined = t2_rides.join(daily_weather(pivoted), "date", "left").join(t2_events, ["date", "borough"], "left")
    filled = joined.withColumns(
        {
            "precip": depth_or_zero(F.col("precip")),
            "snow": depth_or_zero(F.col("snow")),
            "event_count": F.coalesce("event_count", F.lit(0)),
            "event_types": F.coalesce("event_types", F.lit("")),
        }
    )
    return filled.select(*STAGE_TABLES["T2"].names)
