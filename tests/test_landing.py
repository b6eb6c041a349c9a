"""Inputs landed as files of bounded size: what a task holds does not grow with the table."""

from pyspark.sql import functions as F

from pedalgrid.operators import daily
from pedalgrid.plans import incremental
from pedalgrid.sources import readers
from verification import warehouse
from verification.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_no_file_or_document_holds_a_whole_source(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warehouse, "PIECE", 300)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    former = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        files = warehouse.land_everything(spark, FOLDER, str(tmp_path)).collect()
    finally:
        for name, value in former.items():
            spark.conf.set(name, value)
    n = spark.read.parquet(f"{FOLDER}/events.parquet").count()
    of = {s: [r for r in files if r["source"] == s] for s in ("citibike", "events", "noaa")}
    assert len(of["citibike"]) >= 3 * (n // 300) > 3 and len(of["events"]) > 1
    assert all(len({r["filename"] for r in rows}) == len(rows) for rows in of.values())
    rides = readers.read_rides(spark, [r["path"] for r in of["citibike"]]).groupBy(F.col("_metadata.file_path")).count()
    assert max(r["count"] for r in rides.collect()) <= 300
    documents = warehouse.weather_documents(spark, FOLDER).select(F.size(F.split("value", '"datatype"')) - 1).collect()
    assert max(r[0] for r in documents) <= 300
    assert len(of["noaa"]) == len(documents) > 30


def test_pieces_keep_the_order_of_events_and_replace_their_former_landing(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warehouse, "PIECE", 70)
    warehouse.write_weather(spark, FOLDER, str(tmp_path / "weather"))
    read = daily.pivot_weather(readers.read_weather(spark, str(tmp_path / "weather"), "*.txt"))
    assert sorted(read.collect()) == sorted(daily.pivot_weather(warehouse.weather(spark, FOLDER)).collect()) != []

    first = warehouse.land_everything(spark, FOLDER, str(tmp_path / "raw"))
    again = warehouse.land_rides(spark, warehouse.rides(spark, FOLDER), str(tmp_path / "raw"), "2024-06-01", 2)
    landed = incremental._landed(first.unionByName(again)).where("source = 'citibike' and filename like 'rides_2_%'")
    assert {r["path"] for r in landed.collect()} == {r["path"] for r in again.collect()}


def test_incremental_run_over_pieces(spark, monkeypatch):
    monkeypatch.setattr(warehouse, "PIECE", 300)
    found = QUERIES["incremental_w"](spark, FOLDER).drop("rewritten", "other").collect()
    assert sorted(map(str, found)) == sorted(map(str, QUERIES["enriched_w"](spark, FOLDER).collect()))
