"""Least squares of daily rides on temperature, rain and snow, per borough.

The fit needs one aggregation; the solution is column arithmetic on one row per borough. Moments are
centred with exact decimals and scaled to correlations, which keeps the three-by-three solution well
conditioned and makes the singularity test independent of units.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalgrid.functions.measures import average_2dp
from pedalgrid.schemas import COEFFICIENT, MEASURE, STAGE_TABLES

PREDICTORS = ("temp", "precip", "snow")

# --- fixed values -----------------------------------------------------------------------------
MIN_SAMPLES = 4
MIN_VARIANCE = 1e-9
SINGULAR = 1e-12
# ----------------------------------------------------------------------------------------------

_PAIRS = tuple(combinations(PREDICTORS, 2))


def usable_days(t2: DataFrame) -> DataFrame:
    """Days with a temperature."""
    return t2.filter(F.col("temp").isNotNull())


def _number(column: str, kind: str, name: str) -> str:
    """A stored number in its stored type. One that does not fit fails by name; it is never left out of a sum."""
    fits = f"try_cast({column} AS {kind})"
    return f"CASE WHEN {column} IS NOT NULL THEN coalesce({fits}, raise_error('fit_ols: {column} does not fit {kind}')) END AS {name}"


_PRODUCTS = [(p, p) for p in PREDICTORS] + list(_PAIRS) + [(p, "y") for p in PREDICTORS] + [("y", "y")]
#: The fifteen sums by name: the number of days, sums and sums of products.
MOMENTS = ("n", *[f"s_{v}" for v in (*PREDICTORS, "y")], *[f"s_{a}_{b}" for a, b in _PRODUCTS])


def _moments(t2: DataFrame, every_day: bool, *keys: str) -> DataFrame:
    """The sums per borough (and ``keys``); with ``every_day`` also how many days had no temperature, as ``skipped``."""
    days = t2 if every_day else usable_days(t2)
    numbers = days.selectExpr(
        *keys, "borough", *[_number(p, "decimal(18,2)", p) for p in PREDICTORS], _number("total_rides", "decimal(19,0)", "y")
    )
    only = " FILTER (WHERE temp IS NOT NULL)" if every_day else ""
    return numbers.groupBy(*keys, "borough").agg(
        F.expr(f"count(*){only} AS n"),
        *[F.expr(f"sum({v}){only} AS s_{v}") for v in (*PREDICTORS, "y")],
        *[F.expr(f"sum({a} * {b}){only} AS s_{a}_{b}") for a, b in _PRODUCTS],
        *([F.expr("count(*) FILTER (WHERE temp IS NULL) AS skipped")] if every_day else []),
    )


def ols_moments(t2: DataFrame) -> DataFrame:
    """The fifteen sums that determine the fit, exact decimals, one row per borough."""
    return _moments(t2, every_day=False)


def period_moments(t2: DataFrame, period: str) -> DataFrame:
    """The sums per ``period`` and borough: a state that can be kept, added to and taken back period by period."""
    return _moments(t2, False, period)


def combined_moments(state: DataFrame, *more: DataFrame, withdrawn: DataFrame | None = None) -> DataFrame:
    """One row of sums per borough from any number of states, less what is ``withdrawn``.

    All states hold exact decimals, so adding and withdrawing in any order gives the same digits. Withdrawing
    more days than there are fails by name.
    """
    def signed(one: DataFrame, sign: int) -> DataFrame:
        return one.select("borough", *[(F.col(c) if sign > 0 else -F.col(c)).alias(c) for c in MOMENTS])

    rows = signed(state, 1)
    for one in more:
        rows = rows.unionByName(signed(one, 1))
    if withdrawn is not None:
        rows = rows.unionByName(signed(withdrawn, -1))
    kinds = {c: state.schema[c].dataType for c in MOMENTS}
    summed = rows.groupBy("borough").agg(*[F.sum(c).try_cast(kinds[c]).alias(c) for c in MOMENTS])
    fits = F.col("n") >= 0
    for c in MOMENTS:
        fits = fits & F.col(c).isNotNull()
    failed = F.raise_error(F.lit("combined_moments: sums that do not fit, or more withdrawn than there is"))
    checked = summed.withColumn("n", F.when(fits, F.col("n")).otherwise(failed))
    return checked.where(F.col("n") > 0)


def _centred(a: str, b: str) -> str:
    """Sum of products about the means: (n * Sab - Sa * Sb) / n, the numerator exact."""
    exact = f"try_subtract(try_multiply(s_{a}_{b}, cast(n AS decimal(19,0))), try_multiply(s_{a}, s_{b}))"
    return f"cast(CASE WHEN n > 0 THEN coalesce({exact}, raise_error('fit_ols: sums of {a} and {b} beyond 38 digits')) END AS double) / n"


def _solve(moments: DataFrame) -> DataFrame:
    """Coefficients, residual error and the branch each borough took.

    Names of the steps: ``c`` centred sums, ``w`` one over the root of a centred square, ``r``
    correlations between predictors, ``t`` the scaled right-hand side.
    """
    squares = [(p, p) for p in PREDICTORS] + [("y", "y")]
    crosses = list(_PAIRS) + [(p, "y") for p in PREDICTORS]
    centred = moments.selectExpr("*", *[f"{_centred(a, b)} AS c_{a}_{b}" for a, b in squares + crosses])
    # A predictor without variance gets the weight 0: it correlates with nothing and its beta is 0.
    weighted = centred.selectExpr(
        "*", *[f"CASE WHEN c_{p}_{p} > {MIN_VARIANCE} THEN 1 / sqrt(c_{p}_{p}) ELSE 0D END AS w_{p}" for p in PREDICTORS]
    )
    scaled = weighted.selectExpr(
        "*",
        "c_temp_precip * w_temp * w_precip AS r12",
        "c_temp_snow * w_temp * w_snow AS r13",
        "c_precip_snow * w_precip * w_snow AS r23",
        *[f"c_{p}_y * w_{p} AS t{i}" for i, p in enumerate(PREDICTORS, 1)],
    )
    determined = scaled.selectExpr("*", "1 + 2 * r12 * r13 * r23 - r12 * r12 - r13 * r13 - r23 * r23 AS det").selectExpr(
        "*",
        f"CASE WHEN n < {MIN_SAMPLES} THEN 'fallback_too_few_samples' WHEN det < {SINGULAR} THEN 'fallback_singular'"
        " ELSE 'fitted' END AS branch",
    )
    adjugate = {
        "temp": "t1 * (1 - r23 * r23) + t2 * (r13 * r23 - r12) + t3 * (r12 * r23 - r13)",
        "precip": "t1 * (r13 * r23 - r12) + t2 * (1 - r13 * r13) + t3 * (r12 * r13 - r23)",
        "snow": "t1 * (r12 * r23 - r13) + t2 * (r12 * r13 - r23) + t3 * (1 - r12 * r12)",
    }
    slopes = determined.selectExpr(
        "*", *[f"CASE WHEN branch = 'fitted' THEN ({adjugate[p]}) / det * w_{p} ELSE 0D END AS b_{p}" for p in PREDICTORS]
    )
    explained = " + ".join(f"b_{p} * c_{p}_y" for p in PREDICTORS)
    at_means = " + ".join(f"b_{p} * cast(s_{p} AS double)" for p in PREDICTORS)
    fitted = slopes.selectExpr(
        "*", f"(cast(s_y AS double) - ({at_means})) / n AS intercept", f"sqrt(greatest(c_y_y - ({explained}), 0D) / n) AS error"
    )
    is_fitted = F.col("branch") == "fitted"
    mean = average_2dp(F.col("s_y") * 100, F.col("n"))
    return fitted.select(
        "*",
        # Without a usable fit the intercept is the mean, to two decimals.
        F.when(is_fitted, F.round("intercept", 4).cast(COEFFICIENT)).otherwise(mean.cast(COEFFICIENT)).alias("beta0"),
        *[F.round(f"b_{p}", 4).cast(COEFFICIENT).alias(f"beta{i}_{p}") for i, p in enumerate(PREDICTORS, 1)],
        F.when(is_fitted, F.round("error", 2)).otherwise(0.0).cast(MEASURE).alias("rmse"),
    )


def fit_moments(moments: DataFrame) -> DataFrame:
    """Table T3b from one row of sums per borough, without a look at T2."""
    return _solve(moments).select(*STAGE_TABLES["T3b"].names)


def fit_ols(t2: DataFrame) -> DataFrame:
    """Table T3b."""
    return fit_moments(ols_moments(t2))


def fit_counters(t2: DataFrame) -> DataFrame:
    """How many days had no temperature and how many boroughs took each branch of the fit, in one pass over ``t2``."""
    per_borough = _moments(t2, every_day=True)
    # A borough without any temperature has no fit; its days count as skipped.
    solved = _solve(per_borough.withColumn("n", F.nullif("n", F.lit(0))))
    fitted = F.col("branch") == "fitted"
    counted = F.col("n").isNotNull()
    branches = solved.agg(
        F.coalesce(F.sum("skipped"), F.lit(0)).alias("skipped_no_weather"),
        *[F.count(F.when(counted & (F.col("branch") == b), 1)).alias(b) for b in ("fallback_too_few_samples", "fallback_singular")],
        *[F.count(F.when(counted & fitted & (F.col(f"w_{p}") == 0), 1)).alias(f"dropped_{p}_zero_variance") for p in PREDICTORS],
    )
    return branches.unpivot([], branches.columns, "counter", "n")
