"""Quantiles, regression and enrichment, with the published figures of one borough."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from pedalgrid.operators import enrich, regress, stats
from pedalgrid.schemas import STAGE_TABLES
from pedalgrid.session import staged

D = Decimal


def t2_rows(spark, values):
    """Values are (borough, total, temp, precip, snow, event_count); days are numbered per call."""
    start = dt.date(2025, 1, 1)
    data = [
        (start + dt.timedelta(days=i), b, total, 0, D("1.00"), temp, precip, snow, n, "")
        for i, (b, total, temp, precip, snow, n) in enumerate(
            (b, total, *(None if v is None else D(str(v)) for v in (temp, precip, snow)), n)
            for b, total, temp, precip, snow, n in values
        )
    ]
    return spark.createDataFrame(data, STAGE_TABLES["T2"])


# --- fixed values: published daily figures of the Bronx from 31 May to 30 June 2025 ---------------
TOTALS = [
    47, 3613, 5230, 5558, 5865, 5651, 6221, 3702, 3910, 4566, 4143, 5621, 5857, 6180, 2988, 3184,
    5013, 4517, 5542, 3618, 6140, 5074, 4010, 5108, 4753, 5128, 5299, 4800, 4418, 4163, 4650,
]
TEMPS = [
    15.55, 14.45, 16.70, 19.70, 22.50, 25.85, 25.30, 21.65, 20.80, 17.25, 19.75, 22.75, 25.85, 22.50, 17.50, 16.40,
    18.10, 18.05, 23.60, 26.10, 23.60, 26.10, 26.40, 31.15, 32.20, 31.40, 24.15, 19.45, 22.75, 28.35, 26.95,
]
RAIN = {0: 11.70, 6: 0.50, 7: 17.80, 9: 0.30, 10: 10.20, 14: 5.80, 15: 0.80, 16: 3.80, 17: 0.50, 18: 0.80, 19: 16.50, 22: 2.50, 27: 1.80, 28: 1.30}
FORECASTS = [
    4315, 4496, 4738, 4964, 5234, 5124, 2562, 4827, 4501, 3405, 4984, 5234, 4964, 3801, 4367,
    4111, 4540, 4948, 3091, 5052, 5254, 4950, 5661, 5746, 5681, 5097, 4482, 4814, 5435, 5322,
]
# --------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bronx(spark):
    return t2_rows(
        spark, [("Bronx", total, temp, RAIN.get(i, 0), 0, 0) for i, (total, temp) in enumerate(zip(TOTALS, TEMPS, strict=True))]
    )


def test_published_statistics(bronx, rows):
    assert rows(stats.borough_stats(bronx)) == [
        ("Bronx", D("4663.52"), D("1214.56"), D("3910.00"), D("4566.00"), D("5108.00"), D("5621.00"))
    ]


def test_published_regression(bronx, rows):
    assert rows(regress.fit_ols(bronx)) == [("Bronx", D("3150.5209"), D("80.5908"), D("-131.0952"), D("0.0000"), D("922.75"))]
    counters = {r.counter: r.n for r in regress.fit_counters(bronx).collect()}
    assert {k for k, n in counters.items() if n} == {"dropped_snow_zero_variance"}


def test_published_forecasts(bronx):
    w = enrich.enrich(bronx, stats.borough_stats(bronx), regress.fit_ols(bronx), stats.event_thresholds(bronx))
    days = w.orderBy("date").collect()
    assert [r.expected_rides for r in days[1:]] == FORECASTS
    assert [r.anomaly for r in days] == [True] + [False] * 30
    assert days[1].demand_level == "low" and days[4].demand_level == "high" and days[16].demand_level == "average"
    assert {r.event_intensity for r in days} == {"none"}
    assert w.schema.names == STAGE_TABLES["W"].names


def reference_quantile(values, q):
    return sorted(values)[math.floor(q * (len(values) - 1))]


def same(df):
    return df


@pytest.mark.parametrize("pages, measure", [(0, same), (4, same), (32, same), (8, lambda df: staged(df, "quantiles"))])
def test_quantiles_against_sorting(spark, pages, measure):
    random.seed(5)
    groups = {
        "hot": [int(random.expovariate(0.01)) for _ in range(4000)],
        "one": [7],
        "three": [1, 2, 3],
        "ties": [5] * 50 + [6],
        "wide": [random.randrange(10**9) for _ in range(500)],
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("hot", None)], "k string, v bigint")
    quantiles = {"a": 0.0, "b": 0.2, "c": 0.33, "d": 0.4, "e": 0.66, "f": 0.8, "g": 1.0}
    got = {r.k: r for r in stats.quantile_floor(df, ["k"], "v", quantiles, pages, measure).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        for name, q in quantiles.items():
            assert got[k][name] == reference_quantile(vs, q), (k, name)


def test_constant_and_single_values(spark, rows):
    t2 = t2_rows(spark, [("same", 9, 1, 1, 1, 0)] * 6 + [("single", 3, 1, 1, 1, 0)])
    got = {r[0]: r[1:3] for r in rows(stats.borough_stats(t2))}
    assert got == {"same": (D("9.00"), D("0.00")), "single": (D("3.00"), D("0.00"))}


def test_thresholds_use_positive_counts(spark, rows):
    t2 = t2_rows(spark, [("a", 1, 1, 0, 0, n) for n in (0, 0, 5, 1, 3, 2, 4)] + [("b", 1, 1, 0, 0, 0)])
    assert rows(stats.event_thresholds(t2)) == [("a", 2, 3)]


def test_fit_branches(spark, rows):
    exact = [("exact", 10 + 2 * x - 3 * y + 5 * z, x, y, z, 0) for x, y, z in ((1, 2, 0), (2, 1, 1), (3, 5, 2), (4, 0, 7), (5, 5, 5))]
    few = [("few", n, n, 0, 0, 0) for n in (1, 2, 4)]
    flat = [("flat", n, 3, 0, 0, 0) for n in (1, 2, 3, 6)]
    collinear = [("line", n * n, n, 2 * n, 0, 0) for n in (1, 2, 3, 4, 5)]
    missing = [("cold", n, None, 0, 0, 0) for n in (1, 2)]
    t2 = t2_rows(spark, exact + few + flat + collinear + missing)
    got = {r[0]: tuple(map(float, r[1:])) for r in rows(regress.fit_ols(t2))}
    assert got == {
        "exact": (10.0, 2.0, -3.0, 5.0, 0.0),
        "few": (2.33, 0.0, 0.0, 0.0, 0.0),
        "flat": (3.0, 0.0, 0.0, 0.0, 1.87),
        "line": (11.0, 0.0, 0.0, 0.0, 0.0),
    }
    assert {r.counter: r.n for r in regress.fit_counters(t2).collect()} == {
        "skipped_no_weather": 2,
        "fallback_too_few_samples": 1,
        "fallback_singular": 1,
        "dropped_temp_zero_variance": 1,
        "dropped_precip_zero_variance": 1,
        "dropped_snow_zero_variance": 1,
    }


def test_moments_hold_very_large_totals(spark):
    t2 = t2_rows(spark, [("a", 9_000_000_000 + n, n, n * n, n % 3, 0) for n in range(1, 40)])
    assert regress.fit_ols(t2).collect()[0].beta1_temp == D("1.0000")
    assert stats.borough_stats(t2).collect()[0]["mean"] == D("9000000020.00")


def test_enrichment_rules(spark):
    t2 = t2_rows(
        spark,
        [
            ("a", 10, 1, 0, 0, 0),
            ("a", 20, 1, 0, 0, 5),
            ("a", 30, 1, 0, 0, 6),
            ("a", 40, 1, 0, 0, 10),
            ("a", 41, None, 0, 0, 11),
            ("b", 7, 1, 0, 0, 3),
            ("c", 7, 50, 0, 0, 0),
        ],
    )
    schema = STAGE_TABLES
    t3a = spark.createDataFrame([("a", *map(D, ("30", "5", "10", "20", "30", "40")))], schema["T3a"])
    t3b = spark.createDataFrame(
        [("a", *map(D, ("2.5", "1", "0", "0", "1"))), ("c", *map(D, ("10", "-1", "0", "0", "1")))], schema["T3b"]
    )
    t3c = spark.createDataFrame([("a", 5, 10)], schema["T3c"])
    got = [
        (r.borough, r.expected_rides, r.event_intensity, r.anomaly, r.demand_level)
        for r in enrich.enrich(t2, t3a, t3b, t3c).orderBy("date").collect()
    ]
    assert got == [
        ("a", 4, "none", True, "low"),  # 3.5 rounds up
        ("a", 4, "low", False, "below_average"),  # exactly two deviations away
        ("a", 4, "medium", False, "average"),
        ("a", 4, "medium", False, "above_average"),
        ("a", None, "high", True, "high"),
        ("b", None, "low", False, "average"),
        ("c", 0, "none", False, "average"),
    ]


def test_unreadable_numbers(spark, rows):
    t2 = t2_rows(spark, [("a", 1, 1, 0, 0, 4)])
    text = t2.withColumns({"total_rides": t2.total_rides.cast("string"), "event_count": t2.event_count.cast("string")})
    broken = text.replace("4", "x", "event_count").unionByName(text.replace("1", "x", "total_rides"))
    empty = {n: spark.createDataFrame([], STAGE_TABLES[n]) for n in ("T3a", "T3b", "T3c")}
    got = enrich.enrich(broken, empty["T3a"], empty["T3b"], empty["T3c"])
    assert rows(got, "total_rides", "event_intensity") == [(1, "none")]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_fit_with_large_measures(spark, ansi):
    """Values that fill the stored types: the same fit whatever the ANSI setting, or an error that says why."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [(float(k), 123456.78 + 10.0 * (k * k % 7), float(k % 3), 1000 + 3 * k + 2 * (k * k % 7)) for k in range(10)]
        layout = "temp double, precip double, snow double, total_rides bigint"
        t2 = spark.createDataFrame(rows, layout).selectExpr(
            "'A' AS borough", *[f"cast({c} AS decimal(18,2)) AS {c}" for c in ("temp", "precip", "snow")], "total_rides"
        )
        fit = regress.fit_ols(t2).first()
        assert [float(fit[c]) for c in ("beta1_temp", "beta2_precip", "beta3_snow", "rmse")] == pytest.approx([3, 0.2, 0, 0])
        assert regress.ols_moments(t2).first()["n"] == 10
        huge = t2.withColumn("precip", F.lit("1e17").cast("double"))
        with pytest.raises(Exception, match="precip does not fit"):
            regress.fit_ols(huge).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
