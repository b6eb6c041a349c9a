"""Checks, slices, stage tables and exports."""

import datetime as dt
from decimal import Decimal
from types import SimpleNamespace

import pytest

from pedalgrid.operators import checks
from pedalgrid.schemas import STAGE_TABLES
from pedalgrid.session import scratch_dir, staged
from pedalgrid.sources import readers, writers

D = Decimal


def test_compare_counts(spark, rows):
    a = spark.createDataFrame([("kept", 5), ("short", 1)], "decision string, n bigint")
    b = spark.createDataFrame([("kept", 3), ("long", 2)], "decision string, n bigint")
    assert rows(checks.compare_counts(a, b)) == [("kept", 5, 3, 2), ("long", 0, 2, -2), ("short", 1, 0, 1)]


def test_compare_tables(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([("x", 1), (None, 2), (None, 3)], "s string, i int")
    assert rows(checks.compare_tables(a, b)) == [(3, 3, 1, 1)]
    assert rows(checks.compare_tables(a, a)) == [(3, 3, 0, 0)]
    assert rows(checks.compare_tables(a.filter("false"), b.filter("false"))) == [(0, 0, 0, 0)]


def test_grain(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "a int, b int")
    assert rows(checks.check_grain(df, "a", "b")) == [(3, 2, 1)]
    assert rows(checks.check_grain(df.filter("false"), "a")) == [(0, 0, 0)]


def test_month_slice(spark, rows):
    times = ["2024-01-31 23:59:59.999999", "2024-02-01 00:00:00", "2024-02-29 23:59:59.5", "2024-03-01 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").selectExpr("cast(t as timestamp_ntz) t")
    assert rows(checks.month_slice(df, "t", "202402"), "t") == [
        (dt.datetime(2024, 2, 1),),
        (dt.datetime(2024, 2, 29, 23, 59, 59, 500000),),
    ]
    plan = checks.month_slice(df, "t", "202402")._jdf.queryExecution().optimizedPlan().toString()
    assert "last_day" not in plan  # the bounds are constants, so they can be pushed to the scan


def test_pages_by_offset_and_by_cursor(spark):
    df = spark.createDataFrame([(i // 4, i) for i in range(40)], "ts int, id int").orderBy("id", ascending=False)
    whole = [tuple(r) for r in df.orderBy("ts", "id").collect()]
    seen, after = [], None
    for number in range(6):
        by_offset = [tuple(r) for r in checks.page(df, ["ts", "id"], 7, offset=7 * number).collect()]
        by_cursor = [tuple(r) for r in checks.page(df, ["ts", "id"], 7, after=after).collect()]
        assert by_offset == by_cursor
        seen += by_cursor
        after = by_cursor[-1]
    assert seen == whole


W_ROW = (
    dt.date(2025, 6, 1), "Bronx", 10, 5, D("16.70"), None, D("0.00"), D("0.00"), 'A "quoted";B\\c', None, "low", False, "average",
)


def test_stage_text_is_bare(spark, tmp_path, rows):
    df = spark.createDataFrame([W_ROW], STAGE_TABLES["W"])
    path = str(tmp_path / "W")
    writers.write_stage(df, "W", path, "text")
    text = "".join(p.read_text() for p in (tmp_path / "W").glob("part-*"))
    assert text == '2025-06-01\tBronx\t10\t5\t16.70\t\t0.00\t0.00\tA "quoted";B\\c\t\tlow\tfalse\taverage\n'
    assert rows(readers.read_stage(spark, "W", path, "text")) == [W_ROW]


def test_stage_text_skips_short_rows_and_keeps_trailing_empties(spark, tmp_path, rows):
    (tmp_path / "part-0.txt").write_text("2025-06-01\tBronx\t3\t\n2025-06-01\tQueens\t4\n\n")
    assert rows(readers.read_stage(spark, "T2_events", str(tmp_path), "text")) == [(dt.date(2025, 6, 1), "Bronx", 3, "")]
    lenient = readers.read_stage(spark, "T2_events", str(tmp_path), "text", min_fields=3)
    assert rows(lenient, "borough", "event_count", "event_types") == [("Bronx", 3, ""), ("Queens", 4, None)]


@pytest.mark.parametrize("single_file", [True, False])
def test_export(spark, tmp_path, single_file):
    header = "\t".join(STAGE_TABLES["W"].names)
    data = [(dt.date(2025, 6, d), b, *W_ROW[2:]) for d in (3, 1, 2) for b in ("Queens", "Bronx")]
    df = spark.createDataFrame(data, STAGE_TABLES["W"]).repartition(3)
    writers.export_tsv(df, str(tmp_path / "W"), ["date", "borough"], single_file=single_file)
    parts = sorted((tmp_path / "W").glob("part-*"))
    lines = [p.read_text().splitlines() for p in parts if p.stat().st_size]
    assert len(lines) == 1 or not single_file
    assert all(part[0] == header for part in lines)
    body = [line for part in lines for line in part[1:]]
    assert [line.split("\t")[:2] for line in body] == sorted([str(r[0]), r[1]] for r in data)
    assert body[0].endswith('\tA "quoted";B\\c\t\tlow\tfalse\taverage')


def test_staged_table_cuts_the_lineage(spark, rows):
    df = spark.range(10).selectExpr("id", "id % 3 as k")
    table = staged(df, "numbers")
    assert rows(table) == rows(df)
    assert "Range" not in table._jdf.queryExecution().optimizedPlan().toString()


def fake_session(folder, master):
    settings = {} if folder is None else {"spark.checkpoint.dir": folder}
    context = SimpleNamespace(master=master, getConf=lambda: settings)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: settings.get(key, default)), sparkContext=context)


def test_shared_folder_comes_from_the_session():
    assert scratch_dir(fake_session("hdfs://cluster/shared/", "spark://host:7077")) == "hdfs://cluster/shared"
    assert scratch_dir(fake_session("/named", "local[2]")) == "/named"
    assert "pedalgrid" in scratch_dir(fake_session(None, "local[2]"))
    with pytest.raises(ValueError):
        scratch_dir(fake_session(None, "yarn"))


def test_smoke_range(spark, rows):
    assert rows(readers.smoke_range(spark)) == [(142858,)]


def test_preview_and_spot_check(spark, rows):
    df = spark.createDataFrame([(dt.date(2025, 6, d), b) for d in (2, 1) for b in ("b", "a")], "date date, borough string")
    assert [tuple(r) for r in checks.preview(df, ["date", "borough"], 2).collect()] == [
        (dt.date(2025, 6, 1), "a"),
        (dt.date(2025, 6, 1), "b"),
    ]
    assert rows(checks.spot_check(df, "2025-06-02", "a")) == [(dt.date(2025, 6, 2), "a")]


def test_fingerprints_find_single_differences(spark):
    rows = [(k, f"t{k % 7}", float(k), None if k % 5 == 0 else k) for k in range(400)] + [(1, "t1", 1.0, 1)] * 3
    layout = "k long, t string, d double, n long"
    a = spark.createDataFrame(rows, layout)
    zero = [(k, t, -0.0 if d == 0 else d, n) for k, t, d, n in rows]
    assert tuple(checks.compare_by_fingerprint(a, spark.createDataFrame(zero, layout).repartition(5)).first()) == (403, 403, 0, 0)
    for change, only in (
        (rows[:-1], (1, 0)),  # one copy less
        (rows + [rows[7]], (0, 1)),
        (rows[:10] + [(10, "t3", 10.0, 1)] + rows[11:], (1, 1)),  # a null filled
        ([(None, "x", 1.0, 2)] + rows, (0, 1)),
    ):
        b = spark.createDataFrame(change, layout)
        got = tuple(checks.compare_by_fingerprint(a, b).first())
        assert got == (403, len(change), *only) == tuple(checks.compare_tables(a, b).first())
    # Nulls that change places are a difference, although null adds nothing to a hash.
    x, y = spark.createDataFrame([(1, None)], "p int, q int"), spark.createDataFrame([(None, 1)], "p int, q int")
    assert tuple(checks.compare_by_fingerprint(x, y).first()) == (1, 1, 1, 1)
    empty = a.limit(0)
    assert tuple(checks.compare_by_fingerprint(empty, empty).first()) == (0, 0, 0, 0)
    assert tuple(checks.compare_by_fingerprint(a, empty, buckets=3).first()) == (403, 0, 403, 0)


def test_equal_tables_move_buckets_only(spark, tmp_path):
    """The rows of equal tables are not in any plan behind the fingerprints."""
    spark.range(5000).selectExpr("id", "id % 10 AS g").write.parquet(str(tmp_path / "a"))
    a, b = spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "a"))
    plan = checks.compare_by_fingerprint(a, b)._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path) not in plan
    moved = checks.multiset_fingerprint(a)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in moved[moved.index("Exchange hashpartitioning") :] and "hashpartitioning(_bucket" in moved
