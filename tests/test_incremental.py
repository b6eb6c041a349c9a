"""Incremental runs: which files are written again, and that the result is that of a full run."""

import json
from pathlib import Path

import pytest

from pedalgrid.operators import regress
from pedalgrid.plans import demand, incremental
from pedalgrid.schemas import LEDGER

HEADER = (
    "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,"
    "start_lat,start_lng,end_lat,end_lng,member_casual"
)


def ride(n, day, month, station="A"):
    return f"r{n},bike,2025-{month:02d}-{day:02d} 08:00:00,2025-{month:02d}-{day:02d} 08:{10 + n % 40:02d}:30,n,{station},,,1,2,3,4,member"


def rides_of(month, days, per_day=lambda d: 2 + d % 4):
    return [ride(100 * d + n, d, month, "AB"[n % 2]) for d in range(1, days) for n in range(per_day(d))]


def weather_of(month, days, shift=0.0):
    results = [
        {"date": f"2025-{month:02d}-{d:02d}T00:00:00", "datatype": kind, "value": value}
        for d in range(1, days)
        for kind, value in (("TMAX", 20.0 + d % 6 + shift), ("TMIN", 10.5 + d % 4), ("PRCP", float(d % 3)), ("SNOW", float(d % 2)))
    ]
    return json.dumps({"station": "S", "results": results})


class Landing:
    """A ledger over real files; landing a file again adds a newer entry."""

    def __init__(self, spark, root: Path):
        self.spark, self.root, self.rows, self.day = spark, root, [], 0

    def land(self, source, filename, text):
        self.day += 1
        path = self.root / f"raw/{source}/2026-01-{self.day:02d}/{filename}"
        path.parent.mkdir(parents=True)
        path.write_text(text)
        run = f"2026-01-{self.day:02d}"
        self.rows.append((source, filename, run, str(path), path.stat().st_size, None, None, None, f"{run}T00:00:00Z"))

    def rides(self, name, lines):
        self.land("citibike", name, "\n".join([HEADER, *lines]) + "\n")

    def files(self):
        return self.spark.createDataFrame(self.rows, LEDGER)

    def stations(self, a="Bronx"):
        path = self.root / f"stations_{a}.csv"
        path.write_text(f"start_station_id,station_name,latitude,longitude,borough\nA,a,40,-73,{a}\nB,b,40,-73,Queens\n")
        return str(path)

    def full(self, stations):
        inputs = demand.read_landed(self.spark, self.files(), stations)
        return sorted(map(tuple, demand.daily_demand(inputs).collect()), key=str)


@pytest.fixture()
def landing(spark, tmp_path):
    made = Landing(spark, tmp_path)
    made.rides("202505-trips.csv", rides_of(5, 20))
    made.rides("202506-trips.csv", rides_of(6, 18))
    for month in (5, 6):
        made.land("noaa", f"noaa_{month}.json", weather_of(month, 21))
        events = "event_id,event_name,start_date_time,end_date_time,event_agency,event_type,event_borough\n"
        events += "\n".join(f"{month}{d},e,2025-{month:02d}-{d:02d}T10:00:00.000,x,y,Type {d % 3},Bronx" for d in range(1, 15))
        made.land("events", f"events_{month}.csv", events + "\n")
    return made


def written(root: Path, table: str) -> dict[str, set[str]]:
    return {p.name.removeprefix("period="): {f.name for f in p.glob("*.parquet")} for p in (root / table).iterdir() if p.name.startswith("period=")}


def run(spark, landing, out, stations):
    from pedalgrid.sources import readers

    done = incremental.refresh(spark, landing.files(), readers.read_stations(spark, stations), str(out))
    return done, sorted(map(tuple, done.w.collect()), key=str)


def test_only_changed_months_are_written(spark, landing, tmp_path):
    out, stations = tmp_path / "out", landing.stations()
    first, w = run(spark, landing, out, stations)
    assert first.periods["citibike"] == ["202505", "202506"] and w == landing.full(stations) and len(w) > 60
    before = {t: written(out, t) for t in ("T1", "T2_rides", "T2_events", "weather", "moments")}

    # Nothing landed: nothing is read or written.
    again, same = run(spark, landing, out, stations)
    assert same == w and not any(again.periods.values())
    assert before == {t: written(out, t) for t in before}

    # June lands again, with rides of July in the same file.
    landing.rides("202506-trips.csv", rides_of(6, 25) + rides_of(7, 4))
    june, w = run(spark, landing, out, stations)
    assert june.periods["citibike"] == ["202506", "202507"] and june.periods["noaa"] == [] == june.periods["events"]
    assert w == landing.full(stations)
    for t in ("T1", "T2_rides", "moments"):
        now = written(out, t)
        assert now["202505"] == before[t]["202505"] and now["202506"].isdisjoint(before[t]["202506"])
    for t in ("T2_events", "weather"):
        assert written(out, t) == before[t]

    # A file of its own that also has rides of June: the other June file is read again, not lost.
    landing.rides("202506-late.csv", rides_of(6, 3))
    late, w = run(spark, landing, out, stations)
    assert late.periods["citibike"] == ["202506"] and w == landing.full(stations)

    # July goes: its rows are on disk, but no longer in any table.
    landing.rides("202506-trips.csv", rides_of(6, 25))
    gone, w = run(spark, landing, out, stations)
    assert gone.periods["citibike"] == ["202506", "202507"] and w == landing.full(stations)
    assert not any("2025-07" in str(r[0]) for r in w)


def test_weather_changes_the_fit_without_reading_rides(spark, landing, tmp_path):
    out, stations = tmp_path / "out", landing.stations()
    run(spark, landing, out, stations)
    before = written(out, "T1")
    landing.land("noaa", "noaa_5.json", weather_of(5, 21, shift=3.5))
    done, w = run(spark, landing, out, stations)
    assert done.periods == {"citibike": [], "events": [], "noaa": ["202505"], "moments": ["202505"]}
    assert w == landing.full(stations) and written(out, "T1") == before


def test_a_changed_station_touches_all_months(spark, landing, tmp_path):
    out = tmp_path / "out"
    run(spark, landing, out, landing.stations())
    moved = landing.stations("Queens")
    done, w = run(spark, landing, out, moved)
    assert done.periods["citibike"] == ["202505", "202506"] and w == landing.full(moved)


def test_files_without_usable_rows_are_read_once(spark, landing, tmp_path):
    out, stations = tmp_path / "out", landing.stations()
    landing.rides("202504-trips.csv", ["short,row"])
    run(spark, landing, out, stations)
    done, w = run(spark, landing, out, stations)
    assert not any(done.periods.values()) and w == landing.full(stations)


def test_withdrawing_what_was_never_added_fails(spark):
    t2 = spark.createDataFrame([("b", 1.0, 2.0, 3.0, 4)], "borough string, temp double, precip double, snow double, total_rides long")
    one = regress.ols_moments(t2)
    assert regress.combined_moments(one, one, withdrawn=one).collect() == one.collect()
    assert regress.combined_moments(one, withdrawn=one).collect() == []
    with pytest.raises(Exception, match="more withdrawn than there is"):
        regress.combined_moments(one, withdrawn=one.unionAll(one)).collect()
