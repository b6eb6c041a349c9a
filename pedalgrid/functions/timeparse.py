"""Local wall-clock timestamps in New York civil time, at millisecond precision.

A wall clock is held as a ``timestamp`` that shows the local time as if it were UTC. Nothing here
depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalgrid.schemas import LOCAL_ZONE


def compute_once(df: DataFrame, **columns: str) -> DataFrame:
    """Add columns, given as SQL, that later filters read instead of repeating.

    A filter on a plain projected column is moved below the projection together with a copy of the
    whole expression, once per mention. A filter on a generated column stays above its generator.
    """
    row = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return df.selectExpr("*", f"inline(array(struct({row})))")


def wall_clock(text: str, separator: str = " ") -> str:
    """The first nineteen characters, ``yyyy-MM-dd HH:mm:ss``, as a wall clock; null when not a valid date and time."""
    return (
        f"CASE WHEN substring({text}, 11, 1) = '{separator}' AND substring({text}, 14, 1) = ':' AND substring({text}, 17, 1) = ':'"
        f" THEN try_cast(concat(substring({text}, 1, 19), 'Z') AS timestamp) END"
    )


def exists_locally(wall: str, utc: str, zone: str = LOCAL_ZONE) -> str:
    """False for a wall clock that the spring change skips, null for a null one."""
    return f"from_utc_timestamp({utc}, '{zone}') = {wall}"


def fraction_ms(text: str) -> str:
    """All digits after the point read as one whole number of milliseconds, whatever follows them: 0 without a
    point, null without digits and above 999."""
    millis = f"try_cast(regexp_extract(substring({text}, 21), '^0*([0-9]{{1,3}})(?![0-9])', 1) AS int)"
    return f"CASE WHEN substring({text}, 20, 1) = '.' THEN {millis} ELSE 0 END"


def local_instant(wall: str, zone: str = LOCAL_ZONE) -> str:
    """The instant of a wall clock; the later one where the autumn change shows it twice."""
    early = f"to_utc_timestamp({wall}, '{zone}')"
    late = f"{early} + INTERVAL 1 HOUR"
    return f"CASE WHEN from_utc_timestamp({late}, '{zone}') = {wall} THEN {late} ELSE {early} END"


def with_duration_ms(df: DataFrame, start: str, end: str, zone: str = LOCAL_ZONE) -> DataFrame:
    """Add ``duration_ms`` between two ride timestamps, null unless both are valid."""
    texts = df.selectExpr("*", f"trim({start}) AS _s", f"trim({end}) AS _e")
    walls = texts.selectExpr("*", f"{wall_clock('_s')} AS _wall_s", f"{wall_clock('_e')} AS _wall_e")
    utcs = walls.selectExpr(
        "*", f"{local_instant('_wall_s', zone)} AS _utc_s", f"{local_instant('_wall_e', zone)} AS _utc_e"
    )
    valid = f"{exists_locally('_wall_s', '_utc_s', zone)} AND {exists_locally('_wall_e', '_utc_e', zone)}"
    millis = f"unix_millis(_utc_e) - unix_millis(_utc_s) + ({fraction_ms('_e')}) - ({fraction_ms('_s')})"
    timed = compute_once(utcs, duration_ms=f"CASE WHEN {valid} THEN {millis} END")
    return timed.drop("_s", "_e", "_wall_s", "_wall_e", "_utc_s", "_utc_e")


def minutes_2dp(millis: Column) -> Column:
    """Milliseconds to minutes with two decimals, half up, by whole-number arithmetic."""
    hundredths = F.floor((millis + 300) / 600)
    return (hundredths.cast("decimal(8,0)") * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(8,2)")


def ride_date(text: Column) -> Column:
    """The first ten characters, the whole text if shorter."""
    return F.substring(text, 1, 10)


def with_iso_date(df: DataFrame, text: str, name: str = "date", zone: str = LOCAL_ZONE) -> DataFrame:
    """Add the local date of an ISO timestamp, null when not valid; fraction and ``Z`` are ignored."""
    wall = df.selectExpr("*", f"trim({text}) AS _iso").selectExpr("*", f"{wall_clock('_iso', 'T')} AS _wall")
    exists = exists_locally("_wall", f"to_utc_timestamp(_wall, '{zone}')", zone)
    dated = compute_once(wall, **{name: f"CASE WHEN {exists} THEN try_cast(substring(_iso, 1, 10) AS date) END"})
    return dated.drop("_iso", "_wall")


def month_bounds(yyyymm: Column) -> tuple[Column, Column]:
    """First and last day of a ``yyyyMM`` month."""
    first = F.to_date(F.concat(yyyymm, F.lit("01")), "yyyyMMdd")
    return first, F.last_day(first)
