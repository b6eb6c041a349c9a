"""Permits, weather and the daily join."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pedalgrid.operators import clean, daily
from pedalgrid.sources import readers

D = Decimal
PERMIT = "event_id string, start_date_time string, event_type string, event_borough string"


def test_permit_files(spark, tmp_path, rows):
    header = "event_id,event_name,start_date_time,end_date_time,event_agency,event_type,event_borough,event_location"
    run = tmp_path / "2026-01-01"
    run.mkdir()
    (run / "events_202506.csv").write_text(
        "\n".join(
            [
                header,
                '1,"a, b",2025-06-01T10:00:00.000,e,g,Parade,Queens,here',
                "2,n,2025-06-01T23:59:59Z,e,g,Sport,Queens,here",
                "3,n,2025-06-01T10:00:00,e,g,Sport,Queens,here",
                "4,n,2025-06-01T10:00:00,e,g, ,Queens,here",
                "5,n,,e,g,Sport,Queens,here",
                "6,n,2025-06-01T10:00:00,e,g,Sport, ,here",
                "7,n,2025-02-30T10:00:00,e,g,Sport,Queens,here",
                "8,n,2025-03-09T02:30:00,e,g,Sport,Queens,here",
                "9,n,2025-06-01T10:00:00",
            ]
        )
        + "\n"
    )
    (tmp_path / "events_202507.csv").write_text("# nothing in this month\n")
    events = readers.read_events(spark, str(tmp_path))
    counts = {r.decision: r.n for r in clean.event_quality_counts(events).collect()}
    assert counts == {"dropped_short_row": 1, "dropped_empty": 2, "dropped_bad_timestamp": 2, "kept": 4}
    assert rows(daily.daily_events(clean.clean_events(events))) == [(dt.date(2025, 6, 1), "Queens", 4, "Parade;Sport")]


def test_blank_types_count_but_are_not_listed(spark, rows):
    data = [("1", "2025-06-01T10:00:00", None, "Bronx"), ("2", "2025-06-01T10:00:00", "", "Bronx")]
    got = daily.daily_events(clean.clean_events(spark.createDataFrame(data, PERMIT)))
    assert rows(got) == [(dt.date(2025, 6, 1), "Bronx", 2, "")]


def _document(results):
    return json.dumps({"station": "S", "month": "202506", "record_count": len(results), "results": results}, indent=1)


def test_weather_files(spark, tmp_path, rows):
    for run, results in {
        "2026-01-01": [
            {"date": "2025-06-01T00:00:00", "datatype": "TMAX", "value": 20.1},
            {"date": "2025-06-01T00:00:00", "datatype": "TMIN", "value": -3.0},
            {"date": "2025-06-01T00:00:00", "datatype": "PRCP", "value": 1.0},
            {"date": "2025-06-02", "datatype": "TMAX", "value": 10.0},
            {"date": "2025-06-02", "datatype": "AWND", "value": 99.0},
            {"date": "2025-06-03", "datatype": "TMIN", "value": 5.5},
            {"date": "2025-06-03", "datatype": "TMAX"},
            {"date": "2025-06-04", "datatype": "SNOW", "value": 2},
        ],
        "2026-02-01": [
            {"date": "2025-06-01T00:00:00", "datatype": "TMAX", "value": 21.0},
            {"date": "2025-06-01T00:00:00", "datatype": "TMAX", "value": 22.2},
        ],
    }.items():
        (tmp_path / run).mkdir()
        (tmp_path / run / "noaa_202506.json").write_text(_document(results))
    weather = daily.daily_weather(daily.pivot_weather(readers.read_weather(spark, str(tmp_path))))
    assert rows(weather) == [
        (dt.date(2025, 6, 1), D("9.60"), D("1.00"), D("0.00")),
        (dt.date(2025, 6, 2), D("10.00"), D("0.00"), D("0.00")),
        (dt.date(2025, 6, 3), D("5.50"), D("0.00"), D("0.00")),
        (dt.date(2025, 6, 4), None, D("0.00"), D("2.00")),
    ]


T1 = "date date, borough string, member_casual string, ride_duration_min decimal(8,2), start_station_id string"


@pytest.fixture(scope="module")
def t1(spark):
    # One station holds most rides.
    hot = spark.range(3000).select(
        F.lit("2025-06-01").cast("date").alias("date"),
        F.lit("Bronx").alias("borough"),
        F.when(F.col("id") % 3 == 0, "member").otherwise("casual").alias("member_casual"),
        (F.col("id") % 100 + 1).cast("decimal(8,2)").alias("ride_duration_min"),
        F.lit("hot").alias("start_station_id"),
    )
    rest = spark.createDataFrame(
        [
            (dt.date(2025, 6, 1), "Other", "member", D("1.00"), "x"),
            (dt.date(2025, 6, 1), "Other", "casual", D("1.01"), "y"),
            (dt.date(2025, 6, 2), "Queens", None, D("7.25"), "z"),
        ],
        T1,
    )
    return hot.unionByName(rest)


def test_daily_rides(spark, t1, rows):
    expected = [
        (dt.date(2025, 6, 1), "Bronx", 3000, 1000, D("50.50")),
        (dt.date(2025, 6, 1), "Other", 2, 1, D("1.01")),  # 1.005 rounds up
        (dt.date(2025, 6, 2), "Queens", 1, 0, D("7.25")),
    ]
    assert rows(daily.daily_rides(t1)) == expected
    lookup = spark.createDataFrame([("hot", "Bronx"), ("z", "Queens")], "start_station_id string, borough string")
    assert rows(daily.daily_rides_from_kept(t1.drop("borough"), lookup)) == expected


def test_join_keeps_ride_days_only(spark, t1, rows):
    weather = spark.createDataFrame(
        [(dt.date(2025, 6, 1), 10.0, None, 1.5, None), (dt.date(2025, 7, 1), 1.0, 1.0, 1.0, 1.0)],
        "date date, tmax double, tmin double, prcp double, snow double",
    )
    permits = spark.createDataFrame(
        [(dt.date(2025, 6, 1), "Bronx", 3, "Parade"), (dt.date(2025, 6, 1), "Staten Island", 9, "Sport")],
        "date date, borough string, event_count bigint, event_types string",
    )
    got = daily.join_daily(daily.daily_rides(t1), weather, permits)
    assert rows(got, "borough", "temp", "precip", "snow", "event_count", "event_types") == [
        ("Bronx", D("10.00"), D("1.50"), D("0.00"), 3, "Parade"),
        ("Other", D("10.00"), D("1.50"), D("0.00"), 0, ""),
        ("Queens", None, D("0.00"), D("0.00"), 0, ""),
    ]
