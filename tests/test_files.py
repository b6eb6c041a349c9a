"""Whole files: hashes by streaming, one file from many parts, pages, counters of committed rows, a landing run."""

import hashlib
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pedalgrid.functions import measures
from pedalgrid.operators import checks, ledger
from pedalgrid.plans import demand
from pedalgrid.schemas import LEDGER
from pedalgrid.sources import readers, writers
from verification import warehouse

FOLDER = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[1]


def test_files_of_any_size_are_hashed(spark, tmp_path):
    """One file is longer than a Java array; on disk it is a hole."""
    (tmp_path / "a b").mkdir()
    (tmp_path / "a b/empty.bin").write_bytes(b"")
    (tmp_path / "a b/some.csv.gz").write_bytes(b"not really compressed")
    large = tmp_path / "large.bin"
    with large.open("wb") as out:
        out.truncate((1 << 31) + 17)
    got = {r["filename"]: (r["size_bytes"], r["sha256"]) for r in ledger.fingerprint_files(spark, str(tmp_path)).collect()}
    digest, block = hashlib.sha256(), bytes(1 << 20)
    for _ in range(1 << 11):
        digest.update(block)
    digest.update(bytes(17))
    assert got == {
        "large.bin": ((1 << 31) + 17, digest.hexdigest()),
        "some.csv.gz": (21, hashlib.sha256(b"not really compressed").hexdigest()),
    }


def test_one_file_from_many_parts(spark, tmp_path):
    df = spark.range(5000).select("id", F.concat(F.lit("text \"q\" "), F.col("id") % 7).alias("t"), F.when(F.col("id") % 3 == 0, F.col("id") / 4).alias("x"))
    writers.export_tsv(df.repartition(6), str(tmp_path / "joined"), ["t", "id"], single_file=True)
    # The same rows through one task.
    one = df.repartition(1).sortWithinPartitions("t", "id").write.option("header", "true").option("sep", "\t").option("quote", "\u0000").option("emptyValue", "")
    one.csv(str(tmp_path / "task"))
    (joined,) = (tmp_path / "joined").glob("part-*")
    (task,) = (tmp_path / "task").glob("part-*.csv")
    assert joined.read_bytes() == task.read_bytes() and joined.read_bytes().count(b"id\tt") == 1
    assert not (tmp_path / "joined.parts").exists()
    writers.export_tsv(df.limit(0), str(tmp_path / "joined"), ["t"], single_file=True)
    assert [p.read_text() for p in (tmp_path / "joined").glob("part-*")] == ["id\tt\tx\n"]


def test_pages_read_their_own_files(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit("x").alias("v"))
    index = checks.page_index(df, ["k"], rows_per_file=90)
    assert index.rows == 1000 and len(index.files) >= 12
    for offset, limit in ((0, 10), (85, 10), (500, 200), (995, 50), (1000, 5), (5000, 5), (10, 0)):
        assert [r["k"] for r in index.page(offset, limit).collect()] == list(range(1000))[offset : offset + limit]
    assert len(index.page(800, 20).inputFiles()) <= 2
    assert checks.page_index(df.limit(0), ["k"]).page(0, 5).collect() == []


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_numbers_that_do_not_fit_fail_by_name(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for value, high in ((1e17, None), (None, 1e17), (1e30, 2.0), (float("nan"), 1.0)):
            df = spark.createDataFrame([(value, high)], "v double, w double")
            with pytest.raises(Exception, match="temperature: .* does not fit"):
                df.select(measures.temp_avg(F.col("v"), F.col("w"))).collect()
        df = spark.createDataFrame([(1e17,)], "v double")
        with pytest.raises(Exception, match="depth: .* does not fit"):
            df.select(measures.depth_or_zero(F.col("v"))).collect()
        fits = spark.createDataFrame([(999_999_999_999_999.0, None, 1.005)], "v double, w double, x double")
        got = fits.select(measures.temp_avg(F.col("v"), F.col("w")).alias("t"), measures.depth_or_zero(F.col("w")).alias("z"), measures.depth_or_zero(F.col("x")).alias("d")).first()
        assert (str(got["t"]), str(got["z"]), str(got["d"])) == ("999999999999999.00", "0.00", "1.01")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("fmt", ["parquet", "text"])
def test_counters_are_those_of_the_committed_rows(spark, tmp_path, fmt):
    rides, stations = warehouse.rides(spark, FOLDER), warehouse.stations(spark, FOLDER)
    path = str(tmp_path / "T1")
    exact = demand.write_counted_rides(rides, stations, path, fmt)
    observed = demand.write_clean_rides(rides, stations, str(tmp_path / "other"))
    assert exact == observed and exact["kept"] > 0
    written = readers.read_stage(spark, "T1", path, fmt)
    assert checks.compare_tables(written, readers.read_stage(spark, "T1", str(tmp_path / "other"))).first()[2:] == (0, 0)
    assert not Path(f"{path}.decisions").exists()
    # Again over what is there, and without any kept ride.
    assert demand.write_counted_rides(rides, stations, path, fmt) == exact
    none = demand.write_counted_rides(rides.withColumn("start_station_id", F.lit(" ")), stations, path, fmt)
    assert none["kept"] == 0 == readers.read_stage(spark, "T1", path, fmt).count() and none["dropped_no_station"] == rides.count()


RERUN = """
import glob, os, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
local, marker, out = sys.argv[2], sys.argv[3], sys.argv[4]
spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.local.dir", local)
    .config("spark.sql.shuffle.partitions", "4").config("spark.sql.adaptive.enabled", "false").config("spark.sql.autoBroadcastJoinThreshold", "-1").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from pedalgrid.plans import demand
from verification import warehouse

def lose(batches):
    # The first task to write loses the shuffle files of all others: their stage runs again.
    if not os.path.exists(marker):
        open(marker, "w").close()
        for f in glob.glob(local + "/**/shuffle_*", recursive=True):
            os.remove(f)
        raise RuntimeError("lost")
    yield from batches

rides, stations = warehouse.rides(spark, sys.argv[5]), warehouse.stations(spark, sys.argv[5])
spread = rides.repartition(8, "ride_id")
rides = spread.mapInArrow(lose, rides.schema)
print("COUNTERS", demand.write_counted_rides(rides, stations, out))
"""


def test_a_stage_that_runs_twice_counts_once(spark, tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", RERUN, str(REPO), str(tmp_path / "local"), str(tmp_path / "marker"), str(tmp_path / "T1"), FOLDER],
        capture_output=True, text=True, timeout=240,
    )
    assert (tmp_path / "marker").exists(), done.stderr[-2000:]
    line = [x for x in done.stdout.splitlines() if x.startswith("COUNTERS")]
    assert line, done.stderr[-2000:]
    want = demand.write_counted_rides(warehouse.rides(spark, FOLDER), warehouse.stations(spark, FOLDER), str(tmp_path / "want"))
    assert line[0] == f"COUNTERS {want}"


def test_a_landing_run(spark, rows):
    def entries(*given):
        return spark.createDataFrame([tuple(r.get(n) for n in LEDGER.names) for r in given], LEDGER)

    def file(name, size, at="1", source="events", **more):
        return {"source": source, "filename": name, "size_bytes": size, "path": f"/{name}/{at}", "downloaded_at": at, **more}

    expected = spark.createDataFrame([("events", f"f{k}") for k in range(6)] + [("noaa", "n1")], "source string, filename string")
    landed = entries(file("f0", 9), file("f1", 0))
    arrived = entries(
        file("f0", 5, "2"),  # not due
        file("f1", 7, "2"),
        file("f2", 3, "2"), file("f2", 4, "3"),  # two attempts, the second is whole
        file("f3", 8, "2"),  # wrong size
        file("zz", 1, "2"),  # never expected
    )
    sizes = spark.createDataFrame([("events", "f1", 7), ("events", "f2", 4), ("events", "f3", 9), ("events", "f5", 1)], "source string, filename string, size_bytes long")
    records = spark.createDataFrame([("f1", 70), ("f2", 40)], "filename string, record_count long")
    prints = spark.createDataFrame([("/f2/3", 4, "abc")], "path string, size_bytes long, sha256 string")
    done = demand.run_ingest(expected, landed, arrived, sizes, records, prints)
    assert rows(done.pending, "filename") == [("f1",), ("f2",), ("f3",), ("f4",), ("f5",), ("n1",)]
    assert rows(done.mismatched, "filename", "size_bytes", "source_bytes") == [("f3", 8, 9)]
    assert rows(done.ledger, "filename", "size_bytes", "record_count", "sha256") == [("f0", 9, None, None), ("f1", 7, 70, None), ("f2", 4, 40, "abc")]
    assert rows(done.summary) == [("TOTAL", 2, 1, 11, 1, 1), ("events", 2, 1, 11, 1, 1)]
    assert rows(done.entries) == [(3,)]
    # The file that failed is due again, the others are not.
    assert "f3" in {r["filename"] for r in ledger.pending_files(expected, done.ledger).collect()}
    assert demand.run_ingest(expected, done.ledger, arrived.limit(0), sizes).ledger.count() == 3
