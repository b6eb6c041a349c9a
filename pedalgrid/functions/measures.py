"""Business rules of the daily demand table as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from pedalgrid.schemas import COEFFICIENT, MEASURE

#: Measures as read, before they are rounded to two decimals.
_READ = "decimal(22,4)"


def average_2dp(hundredths: Column, n: Column) -> Column:
    """Half-up average with two decimals of ``n`` values whose sum is given in hundredths."""
    total, count = hundredths.cast("decimal(38,0)"), n.cast("decimal(20,0)")
    rounded = F.call_function("div", total * 2 + count, count * 2)
    return (rounded.cast("decimal(19,0)") * F.lit(0.01).cast("decimal(2,2)")).cast(MEASURE)


def _fitting(value: Column, kind: str | DataType, name: str) -> Column:
    """A number in a decimal type; one that does not fit fails by name, whatever the ANSI setting."""
    failed = F.raise_error(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(" does not fit"))).cast(kind)
    return F.when(value.isNotNull(), F.coalesce(value.try_cast(kind), failed))


def temp_avg(tmax: Column, tmin: Column) -> Column:
    """Mean of the two, else whichever is present."""
    high, low = (_fitting(t, _READ, "temperature") for t in (tmax, tmin))
    both = (high + low) * F.lit(0.5).cast("decimal(2,1)")
    return _fitting(F.coalesce(*[t.cast("decimal(25,5)") for t in (both, high, low)]), MEASURE, "temperature")


def depth_or_zero(value: Column) -> Column:
    """Rain or snow, zero when not reported."""
    return F.coalesce(_fitting(_fitting(value, _READ, "depth"), MEASURE, "depth"), F.lit(0).cast(MEASURE))


def expected_rides(
    beta0: Column, b_temp: Column, b_precip: Column, b_snow: Column, temp: Column, precip: Column, snow: Column
) -> Column:
    """Regression forecast, never negative, whole rides half up; null without a model or a temperature."""

    def term(beta: Column, value: Column) -> Column:
        return beta.cast(COEFFICIENT) * value.cast(MEASURE)

    zero = F.lit(0).cast(MEASURE)
    linear = (
        beta0.cast(COEFFICIENT)
        + term(b_temp, temp)
        + term(b_precip, F.coalesce(precip.cast(MEASURE), zero))
        + term(b_snow, F.coalesce(snow.cast(MEASURE), zero))
    )
    # greatest() skips nulls, so a missing forecast has to be kept missing explicitly.
    return F.when(linear.isNotNull(), F.round(F.greatest(linear, F.lit(0)), 0).cast("bigint"))


def event_intensity(n: Column, p33: Column, p66: Column) -> Column:
    return (
        F.when(n == 0, "none")
        .when(p33.isNull() | (n <= p33), "low")
        .when(n <= p66, "medium")
        .otherwise("high")
    )


def is_anomaly(total: Column, mean: Column, stddev: Column) -> Column:
    """More than two standard deviations from the mean; false without statistics."""
    return F.coalesce(F.abs(total - mean) > stddev * 2, F.lit(False))


def demand_level(total: Column, q20: Column, q40: Column, q60: Column, q80: Column) -> Column:
    return (
        F.when(q20.isNull(), "average")
        .when(total <= q20, "low")
        .when(total <= q40, "below_average")
        .when(total <= q60, "average")
        .when(total <= q80, "above_average")
        .otherwise("high")
    )
