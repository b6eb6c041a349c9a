"""Ride parsing, decisions and cleaning."""

from decimal import Decimal

import pytest
from pyspark.sql import Observation

from pedalgrid.operators import clean
from pedalgrid.plans import demand
from pedalgrid.schemas import RIDE_DECISIONS, STAGE_TABLES
from pedalgrid.sources import readers, writers

CASES = [
    # start, end, station, decision, milliseconds
    ("2025-06-01 10:00:00", "2025-06-01 10:01:00", "A", "kept", 60_000),
    ("2025-06-01 10:00:00.900", "2025-06-01 10:01:00.100", "A", "dropped_too_short", 59_200),
    ("2025-06-01 10:00:00", "2025-06-02 10:00:00", "A", "kept", 86_400_000),
    ("2025-06-01 10:00:00.000", "2025-06-02 10:00:00.001", "A", "dropped_too_long", 86_400_001),
    ("2025-06-01 10:00:00", "2025-06-01 10:10:00.500", "A", "kept", 600_500),
    ("2025-06-01 10:00:00.5", "2025-06-01 10:10:00", "A", "kept", 599_995),
    ("2025-06-01 10:10:00", "2025-06-01 10:00:00", "A", "dropped_too_short", -600_000),
    ("2025-06-01 10:00:00", "2025-06-01 10:10:00", None, "dropped_no_station", 600_000),
    ("2025-06-01 10:00:00", "2025-06-01 10:10:00", "", "dropped_no_station", 600_000),
    ("2025-06-01 10:00:00", "2025-06-01 10:10:00", "   ", "dropped_no_station", 600_000),
    ("garbage garbage gar", "2025-06-01 10:10:00", "A", "dropped_bad_timestamp", None),
    ("2025-06-01", "2025-06-01 10:10:00", "A", "dropped_bad_timestamp", None),
    ("2025-02-30 10:00:00", "2025-06-01 10:10:00", "A", "dropped_bad_timestamp", None),
    ("2025-06-01 10:00:00.123456", "2025-06-01 10:10:00", "A", "dropped_bad_timestamp", None),
    ("2025-06-01 10:00:00.", "2025-06-01 10:10:00", "A", "dropped_bad_timestamp", None),
    ("2025-06-01 10:00:00.+5", "2025-06-01 10:10:00", "A", "dropped_bad_timestamp", None),
    ("2025-06-01 10:00:00", "2025-06-01 10:05:00.00000000012", "A", "kept", 300_012),
    ("2025-06-01 10:00:00", "2025-06-01 10:05:00.5abc", "A", "kept", 300_005),
    ("2025-06-01 10:00:00", "2025-06-01 10:05:00.000", "A", "kept", 300_000),
    ("2025-06-01 10:00:00", "2025-06-01 10:05:00.00000001000", "A", "dropped_bad_timestamp", None),
    # The hour that the autumn change shows twice counts as the later one, in standard time.
    ("2025-11-02 00:50:00", "2025-11-02 01:10:00", "A", "kept", 4_800_000),
    ("2025-11-02 01:50:00", "2025-11-02 02:10:00", "A", "kept", 1_200_000),
    ("2025-11-02 01:10:00", "2025-11-02 01:50:00", "A", "kept", 2_400_000),
    ("2025-11-02 00:30:00", "2025-11-02 02:30:00", "A", "kept", 10_800_000),
    ("2025-06-01 24:00:00", "2025-06-02 10:10:00", "A", "dropped_bad_timestamp", None),
    (None, "2025-06-01 10:10:00", "A", "dropped_bad_timestamp", None),
    # Clocks skip 02:00-03:00 on this night, so the first is invalid and the second lasts half an hour.
    ("2025-03-09 02:30:00", "2025-03-09 03:30:00", "A", "dropped_bad_timestamp", None),
    ("2025-03-09 01:45:00", "2025-03-09 03:15:00", "A", "kept", 1_800_000),
    # Clocks repeat 01:00-02:00 on this night; three hours on the clock are four.
    ("2025-11-02 00:30:00", "2025-11-02 03:30:00", "A", "kept", 14_400_000),
    # Several faults: the station is reported first.
    ("garbage", "garbage", " ", "dropped_no_station", None),
    ("  2025-06-01 10:00:00  ", "2025-06-01 10:10:00", " A ", "kept", 600_000),
]


@pytest.fixture(scope="module")
def rides(spark):
    data = [(str(i), "classic_bike", s, e, st, "member") for i, (s, e, st, _, _) in enumerate(CASES)]
    return spark.createDataFrame(
        data,
        "ride_id string, rideable_type string, started_at string, ended_at string, start_station_id string, member_casual string",
    )


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_decisions_do_not_depend_on_the_session_zone(spark, rides, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {int(r.ride_id): (r.decision, r.duration_ms) for r in clean.tag_rides(rides).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {i: (decision, ms) for i, (_, _, _, decision, ms) in enumerate(CASES)}


def test_counters_cover_every_row_and_label(spark, rides):
    counts = {r.decision: r.n for r in clean.quality_counts(clean.tag_rides(rides)).collect()}
    assert set(counts) == set(RIDE_DECISIONS)
    assert counts["dropped_short_row"] == 0
    assert sum(counts.values()) == len(CASES)


def test_t1_columns_and_boroughs(spark, rides):
    stations = spark.createDataFrame(
        [("A", "n", 0.0, 0.0, "Queens"), (" A ", "n", 0.0, 0.0, "Bronx")],
        "start_station_id string, station_name string, latitude double, longitude double, borough string",
    )
    t1 = clean.clean_rides(rides, clean.station_lookup(stations))
    assert t1.schema.names == STAGE_TABLES["T1"].names
    kept = {int(r.ride_id): r for r in t1.collect()}
    assert set(kept) == {i for i, c in enumerate(CASES) if c[3] == "kept"}  # ids repeated in the lookup add no rows
    assert {r.borough for r in kept.values()} == {"Queens"}
    assert kept[4].ride_duration_min == Decimal("10.01")
    assert kept[0].start_station_id == "A" and str(kept[max(kept)].date) == "2025-06-01"
    unknown = clean.clean_rides(rides, clean.station_lookup(stations.filter("false")))
    assert {r.borough for r in unknown.select("borough").collect()} == {"Other"}


RIDE_HEADER = (
    "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,"
    "start_lat,start_lng,end_lat,end_lng,member_casual"
)


def _line(ride_id, name='"W 21 St, 6 Ave"', member="member", extra=""):
    return f"{ride_id},bike,2025-06-01 10:00:00,2025-06-01 10:05:00,{name},A,x,y,1,2,3,4,{member}{extra}"


def test_ride_files(spark, tmp_path, rows):
    (tmp_path / "202506-trips_1.csv").write_text(
        "\n".join([RIDE_HEADER, _line("a"), "", _line("b", name='"say ""hi"""'), "c,bike,2025-06-01 10:00:00"]) + "\n"
    )
    (tmp_path / "202506-trips_2.csv").write_text(
        "\n".join([RIDE_HEADER, _line("d", extra=",more"), _line("e", member="", extra=',"x,y"'), _line("f", member="")]) + "\n"
    )
    (tmp_path / "202507-trips_1.csv").write_text(RIDE_HEADER + "\n" + _line("g") + "\n")
    path = str(tmp_path)

    everything = readers.read_rides(spark, path)
    tagged = {r.ride_id: r.decision for r in clean.tag_rides(everything).collect()}
    assert tagged == {"a": "kept", "b": "kept", "c": "dropped_short_row", "d": "kept", "e": "kept", "f": "kept", "g": "kept"}
    assert rows(everything.filter("ride_id in ('a', 'b')"), "start_station_name") == [("W 21 St, 6 Ave",), ('say "hi"',)]

    month = readers.read_rides(spark, path, month="2025-07")
    assert rows(month, "ride_id") == [("g",)]
    sample = readers.read_rides(spark, path, sample=True)
    assert rows(sample, "ride_id") == [("a",), ("b",), ("c",), ("g",)]
    both = readers.read_rides(spark, path, month="202506", sample=True)
    assert rows(both, "ride_id") == [("a",), ("b",), ("c",)]


def test_short_rows_are_seen_whatever_columns_are_used(spark, tmp_path):
    (tmp_path / "202506.csv").write_text(_line("a") + "\nb,bike\n")
    counts = clean.quality_counts(clean.tag_rides(readers.read_rides(spark, str(tmp_path))))
    assert {r.decision: r.n for r in counts.collect() if r.n} == {"kept": 1, "dropped_short_row": 1}


def test_one_pass_writes_t1_and_counts(spark, rides, tmp_path):
    stations = spark.createDataFrame([], "start_station_id string, borough string")
    counters = demand.write_clean_rides(rides, stations, str(tmp_path / "T1"))
    kept = sum(c[3] == "kept" for c in CASES)
    assert counters["kept"] == kept and sum(counters.values()) == len(CASES)
    assert readers.read_stage(spark, "T1", str(tmp_path / "T1")).count() == kept


def test_observation_equals_grouped_counts(spark, rides):
    observation = Observation()
    clean.observe_quality(clean.tag_rides(rides), observation).write.format("noop").mode("overwrite").save()
    grouped = {r.decision: r.n for r in clean.quality_counts(clean.tag_rides(rides)).collect()}
    assert dict(observation.get) == grouped


def test_station_file_last_row_wins(spark, tmp_path, rows):
    path = tmp_path / "stations.csv"
    path.write_text(
        "start_station_id,station_name,latitude,longitude,borough\n"
        "A,first,1.0,2.0,Bronx\n"
        " A ,second,1.5,2.5, Queens \n"
        "B,short,1.0,2.0\n"
        'C,"x, y",bad,2.0,Bronx,extra\n'
    )
    got = rows(readers.read_stations(spark, str(path)))
    assert got == [("A", "second", 1.5, 2.5, "Queens"), ("C", "x, y", None, 2.0, "Bronx")]


def test_station_csv_has_six_decimals(spark, tmp_path, rows):
    schema = "start_station_id string, station_name string, latitude double, longitude double, borough string"
    df = spark.createDataFrame([("A", 'q "r", s', 40.1234567, -73.0, "Bronx")], schema)
    writers.write_stations(df, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert "40.123457,-73.000000,Bronx" in text
    assert rows(readers.read_stations(spark, str(tmp_path / "out"))) == [("A", 'q "r", s', 40.123457, -73.0, "Bronx")]
