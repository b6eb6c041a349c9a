"""File ledger: expected, pending, upsert, summary."""

import datetime as dt
import hashlib
import json

import pytest

from pedalgrid.operators import ledger
from pedalgrid.plans import demand
from pedalgrid.schemas import LEDGER
from pedalgrid.sources import readers, writers


def entries(spark, *rows):
    names = LEDGER.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], LEDGER)


def entry(source, filename, size=1, **more):
    return {"source": source, "filename": filename, "size_bytes": size, **more}


def test_expected_files(spark):
    got = ledger.expected_files(ledger.month_range(spark)).collect()
    assert len(got) == 27
    by_key = {(r.source, r.month): r for r in got}
    assert by_key["citibike", "202503"].filename == "202503-citibike-tripdata.zip"
    assert by_key["noaa", "202511"].filename == "noaa_USW00094728_202511.json"
    june = by_key["events", "202506"]
    assert (june.filename, june.month_start, june.month_end) == ("events_202506.csv", dt.date(2025, 6, 1), dt.date(2025, 6, 30))
    leap = ledger.expected_files(ledger.month_range(spark, "202402", "202402")).collect()
    assert {r.month_end for r in leap} == {dt.date(2024, 2, 29)}


def test_pending_and_idempotence(spark, rows):
    expected = spark.createDataFrame(
        [("events", f"f{i}", "new") for i in range(6)] + [("noaa", "f1", None)], "source string, filename string, dataset_id string"
    )
    landed = entries(
        spark,
        entry("events", "f1", dataset_id="new"),
        entry("events", "f2", size=0, dataset_id="new"),
        entry("events", "f3", dataset_id="old"),
        entry("events", "f4", dataset_id=None),
        entry("events", "f5", dataset_id=""),
        entry("noaa", "f1", dataset_id="any"),
    )
    pending, summary = demand.plan_ingest(expected, landed)
    assert rows(pending, "source", "filename") == [("events", "f0"), ("events", "f2"), ("events", "f3")]
    assert rows(summary, "source", "new_files", "skipped_files") == [("TOTAL", 3, 4), ("events", 3, 3), ("noaa", 0, 1)]

    run = entries(spark, *[entry(r.source, r.filename, 5, dataset_id="new", downloaded_at="t") for r in pending.collect()])
    after = ledger.upsert_ledger(landed, run)
    assert after.count() == 7
    assert ledger.pending_files(expected, after).count() == 0
    assert rows(ledger.pending_files(expected.drop("dataset_id"), readers.read_ledger(spark, None))) == sorted(
        tuple(r) for r in expected.drop("dataset_id").collect()
    )


def test_upsert_keeps_the_newest_of_the_run(spark, rows):
    old = entries(spark, entry("a", "x", 1, downloaded_at="9"), entry("a", "y", 1, downloaded_at="1"))
    new = entries(spark, entry("a", "x", 2, downloaded_at="2"), entry("a", "x", 3, downloaded_at="3"))
    assert rows(ledger.upsert_ledger(old, new), "filename", "size_bytes") == [("x", 3), ("y", 1)]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_snapshot(spark, tmp_path, rows, fmt):
    df = entries(spark, entry("noaa", "b", 2, run_date="2026-01-01"), entry("events", "a", 1), entry("unknown", "c", 1))
    root = str(tmp_path / "ledger")
    writers.write_ledger(df, root, fmt)
    back = readers.read_ledger(spark, root, fmt)
    assert rows(back) == rows(df.filter("source <> 'unknown'"))
    assert rows(ledger.ledger_size(back)) == [(2,)]
    writers.write_ledger(ledger.upsert_ledger(back, entries(spark, entry("events", "a", 9, downloaded_at="t"))), root, fmt)
    assert rows(readers.read_ledger(spark, root, fmt), "filename", "size_bytes") == [("a", 9), ("b", 2)]


def test_nested_manifest(spark, tmp_path, rows):
    path = tmp_path / "manifest.json"
    document = {
        "version": 1,
        "last_updated": "t",
        "sources": {
            "events": {"e1": {"run_date": "d", "hdfs_path": "/raw/e1", "size_bytes": 7, "dataset_id": "x", "note": 1}},
            "noaa": {},
            "other": {"o1": {"size_bytes": 1}},
        },
    }
    path.write_text(json.dumps(document, indent=2))
    got = readers.read_ledger(spark, str(path), "manifest")
    assert rows(got, "source", "filename", "path", "size_bytes", "dataset_id") == [("events", "e1", "/raw/e1", 7, "x")]
    path.write_text("{broken")
    with pytest.raises(Exception):
        readers.read_ledger(spark, str(path), "manifest").collect()


@pytest.mark.parametrize("fmt", ["parquet", "json", "manifest"])
def test_absent_ledger_is_empty(spark, tmp_path, fmt):
    assert readers.read_ledger(spark, str(tmp_path / "none"), fmt).count() == 0


def test_corrupt_snapshot_fails(spark, tmp_path):
    (tmp_path / "part.json").write_text("{not json\n")
    with pytest.raises(Exception):
        readers.read_ledger(spark, str(tmp_path), "json").collect()


def test_latest_and_current_paths(spark, rows):
    df = entries(
        spark,
        entry("noaa", "202506", run_date="2026-01-01", path="/1/202506"),
        entry("noaa", "202507", run_date="2026-01-01", path="/1/202507"),
        entry("noaa", "202506", run_date="2026-02-01", path="/2/202506"),
        entry("events", "202512", run_date="2026-03-01"),
    )
    assert rows(readers.latest(df, "noaa"), "filename") == [("202507",)]
    assert rows(readers.latest(df, "noaa", "run_date"), "path") == [("/2/202506",)]
    assert rows(ledger.current_paths(df, "noaa"), "path") == [("/1/202507",), ("/2/202506",)]


def test_sizes_and_fingerprints(spark, tmp_path, rows):
    (tmp_path / "a.bin").write_bytes(b"hello")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.bin").write_bytes("zażółć".encode())
    files = readers.list_files(spark, str(tmp_path))
    assert rows(files, "filename", "size_bytes") == [("a.bin", 5), ("b.bin", 10)]
    got = {r.filename: (r.size_bytes, r.sha256) for r in ledger.fingerprint_files(spark, str(tmp_path)).collect()}
    assert got["b.bin"] == (10, hashlib.sha256("zażółć".encode()).hexdigest())
    landed = entries(spark, entry("s", "a.bin", 5), entry("s", "b.bin", 9))
    theirs = entries(spark, entry("s", "a.bin", 5), entry("s", "b.bin", 10), entry("s", "c.bin", 1))
    assert rows(ledger.reconcile_sizes(landed, theirs), "filename", "size_bytes", "source_bytes") == [("b.bin", 9, 10)]


def test_records_per_file(spark, tmp_path, rows):
    (tmp_path / "a.txt").write_text("1\n2\n")
    (tmp_path / "b.txt").write_text("3\n")
    assert rows(ledger.records_per_file(spark.read.text(str(tmp_path)))) == [("a.txt", 2), ("b.txt", 1)]


def test_failing_source_does_not_stop_the_run(spark, rows):
    def broken():
        raise RuntimeError("no network")

    log = ledger.run_sources(spark, {"a": lambda: {"new_files": 2, "bytes_pulled": 10}, "b": broken, "c": lambda: {"skipped_files": 3}})
    assert rows(ledger.ingest_summary(log)) == [
        ("TOTAL", 2, 3, 10, 1, 0),
        ("a", 2, 0, 10, 0, 0),
        ("b", 0, 0, 0, 1, 0),
        ("c", 0, 3, 0, 0, 0),
    ]


def test_empty_log(spark, rows):
    assert rows(ledger.ingest_summary(spark.createDataFrame([], ledger.RUN_LOG))) == [("TOTAL", 0, 0, 0, 0, 0)]


def test_ties_in_the_ledger_are_settled(spark, rows):
    entry = "source string, filename string, run_date string, path string, size_bytes bigint, downloaded_at string"
    run = [("events", "a", "2025-01-01", f"/{k}/a", size, "2025-01-01T00:00:00Z") for k, size in (("x", 1), ("z", 5), ("y", 5))]
    for order in (run, run[::-1]):
        new = spark.createDataFrame(order, entry).repartition(3)
        assert rows(ledger.upsert_ledger(new.limit(0), new), "path") == [("/z/a",)]
        assert rows(ledger.current_paths(new, "events"), "path") == [("/z/a",)]


def test_only_the_newest_snapshot_is_opened(spark, tmp_path):
    old = tmp_path / "snapshot=20200101T000000Z"
    old.mkdir()
    (old / "part-0.parquet").write_text("not a parquet file")
    entry = readers.read_ledger(spark, None)
    writers.write_ledger(entry, str(tmp_path))
    assert readers.read_ledger(spark, str(tmp_path)).count() == 0
