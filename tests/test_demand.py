"""From raw files to the enriched table, by stages and as one plan."""

import json

import pytest
from pyspark.sql import functions as F

from pedalgrid.operators import checks, clean, daily
from pedalgrid.plans import demand
from pedalgrid.schemas import STAGE_TABLES
from pedalgrid.sources import readers

HEADER = (
    "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,"
    "start_lat,start_lng,end_lat,end_lng,member_casual"
)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for folder in ("rides", "weather/2026-01-01", "events/2026-01-01"):
        (root / folder).mkdir(parents=True)
    lines = [HEADER]
    for day in range(1, 21):
        for n in range(3 + day * 5 % 7):
            station, kind = ("A", "B", "", "Z")[n % 4], "member" if n % 2 else "casual"
            lines.append(f"r{day}_{n},bike,2025-06-{day:02d} 08:00:00,2025-06-{day:02d} 08:{10 + n}:30.250,n,{station},,,1,2,3,4,{kind}")
    lines.append("short,row")
    (root / "rides" / "202506-trips_1.csv").write_text("\n".join(lines) + "\n")
    (root / "stations.csv").write_text(
        "start_station_id,station_name,latitude,longitude,borough\nA,a,40.000000,-73.000000,Bronx\nB,b,40.000000,-73.000000,Queens\n"
    )
    events = ["event_id,event_name,start_date_time,end_date_time,event_agency,event_type,event_borough"]
    events += [f"{d}{n},e,2025-06-{d:02d}T10:00:00.000,x,y,Type {n % 3},Bronx" for d in range(1, 19) for n in range(d % 5)]
    (root / "events/2026-01-01/events_202506.csv").write_text("\n".join(events) + "\n")
    results = [
        {"date": f"2025-06-{d:02d}T00:00:00", "datatype": kind, "value": value}
        for d in range(1, 20)
        for kind, value in (("TMAX", 20.0 + d % 6), ("TMIN", 10.5 + d % 4), ("PRCP", float(d % 3)), ("SNOW", 0.0))
    ]
    (root / "weather/2026-01-01/noaa_202506.json").write_text(json.dumps({"station": "S", "results": results}))
    return root


@pytest.fixture(scope="module")
def inputs(spark, raw):
    return demand.read_inputs(spark, str(raw / "rides"), str(raw / "stations.csv"), str(raw / "events"), str(raw / "weather"), "2025-06")


@pytest.mark.parametrize("fmt", ["parquet", "text"])
def test_stages_equal_the_single_plan(spark, inputs, tmp_path, rows, fmt):
    out = str(tmp_path / "stages")
    counters = demand.run_stages(inputs, out, fmt)
    t1 = readers.read_stage(spark, "T1", f"{out}/T1", fmt)
    assert counters["dropped_short_row"] == 1 and counters["dropped_no_station"] > 0
    assert counters["kept"] == t1.count()

    w = readers.read_stage(spark, "W", f"{out}/W", fmt)
    assert w.schema.names == STAGE_TABLES["W"].names
    assert {r.borough for r in w.select("borough").distinct().collect()} == {"Bronx", "Queens", "Other"}
    assert w.agg({"total_rides": "sum"}).collect()[0][0] == counters["kept"]
    (grain,) = checks.check_grain(w, "date", "borough").collect()
    assert grain.repeated_keys == 0
    (parity,) = checks.compare_tables(w, demand.daily_demand(inputs)).collect()
    assert (parity.only_a, parity.only_b) == (0, 0) and parity.rows_a == parity.rows_b > 0

    demand.export_reports(spark, out, str(tmp_path / "reports"), fmt)
    (report,) = [p for p in (tmp_path / "reports" / "W").glob("part-*") if p.stat().st_size]
    lines = report.read_text().splitlines()
    assert lines[0].split("\t") == STAGE_TABLES["W"].names and len(lines) == w.count() + 1
    assert lines[1:] == sorted(lines[1:])


def test_last_day_has_no_weather(inputs):
    last = demand.daily_demand(inputs).filter("date = date '2025-06-20'").collect()
    assert last and all(r.temp is None and r.expected_rides is None and r.precip == 0 for r in last)


def test_rides_are_scanned_once_for_w(inputs):
    plan = demand.daily_table(inputs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3  # rides, stations, permits
    w = demand.daily_demand(inputs)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in w  # W and its statistics read the staged days, not the rides


def test_hot_station_with_a_lookup_too_large_to_broadcast(spark, rows):
    """A third of all rides on one station: shuffled joins give the same tables as broadcast ones."""
    minutes = F.col("id") % 50 + 1
    rides = spark.range(30_000).select(
        F.col("id").cast("string").alias("ride_id"),
        F.lit("bike").alias("rideable_type"),
        F.lit("2025-06-01 10:00:00").alias("started_at"),
        F.concat(F.lit("2025-06-01 10:"), F.lpad(minutes.cast("string"), 2, "0"), F.lit(":00")).alias("ended_at"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 997).cast("string")).alias("start_station_id"),
        F.lit("member").alias("member_casual"),
    )
    stations = spark.range(997).select(
        F.col("id").cast("string").alias("start_station_id"), F.format_string("b%d", F.col("id") % 5).alias("borough")
    )
    stations = stations.unionByName(spark.createDataFrame([("hot", "b9")], stations.schema))
    lookup = demand.measured_lookup(stations)

    def tables():
        kept = clean.kept_rides(rides)
        row_level = daily.daily_rides(clean.assign_borough(kept, lookup))
        return row_level, daily.daily_rides_from_kept(kept, lookup)

    expected = [rows(t) for t in tables()]
    assert expected[0] == expected[1]
    assert ("b9", 10_000) in [r[1:3] for r in expected[0]]
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16kb",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        shuffled = tables()
        assert [rows(t) for t in shuffled] == expected
        joined = clean.assign_borough(clean.kept_rides(rides), lookup)
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan  # the hot station was split over tasks
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
