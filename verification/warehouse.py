"""The warehouse tables seen as the inputs of the demand model.

Each view is a plain projection or join over whole tables, so its size follows theirs. Dates of the
event stream (January 2024) are moved by sixty days: March then holds the night on which clocks go
forward, so invalid local times occur naturally.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalgrid.plans.demand import Inputs
from pedalgrid.schemas import EVENTS_SOURCE, LEDGER, LEDGER_SOURCES, RIDES_SOURCE, WEATHER_SOURCE
from pedalgrid.sources.readers import LOAD_ORDER, list_files, polygons_from_features, weather_rows
from pedalgrid.sources.writers import write_rides

SHIFT_DAYS = 60
EVENT_ORDER = "event_id"
#: So many ids of events go into one landed file or document, however many events there are.
PIECE = 200_000

# Declared layouts: reading a table then needs no look at its files beforehand.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _shifted(ts: Column) -> Column:
    return ts + F.expr(f"interval {SHIFT_DAYS} days")


def _clock_text(text: Column, whole_seconds: Column) -> Column:
    """Text of a timestamp with three fraction digits, or none."""
    fraction = F.rpad(F.substring(text, 21, 3), 3, "0")
    return F.when(whole_seconds, F.substring(text, 1, 19)).otherwise(F.concat(F.substring(text, 1, 19), F.lit("."), fraction))


def rides(spark: SparkSession, folder: str) -> DataFrame:
    """Events as raw rides of five times ``value`` minutes, all fields text as in the CSV files."""
    e = table(spark, folder, "events")
    value = F.col("value")
    coordinate = value.cast("decimal(12,2)").cast("string")
    start = _shifted(F.col("ts"))
    end = F.timestamp_add("SECOND", F.floor(value * 300 + 0.5).cast("int"), start)
    e = e.withColumns({"start_text": start.cast("string"), "end_text": end.cast("string")})
    seconds_only = F.col("event_type") == "click"
    padded = F.when(F.col("event_type") == "signup", F.concat(F.lit(" "), "user_id", F.lit(" "))).otherwise(
        F.col("user_id").cast("string")
    )
    return e.select(
        F.col("event_id").cast("string").alias("ride_id"),
        F.col("event_type").alias("rideable_type"),
        _clock_text(F.col("start_text"), seconds_only).alias("started_at"),
        F.when(value.between(100, 105), "n/a").otherwise(_clock_text(F.col("end_text"), seconds_only)).alias("ended_at"),
        F.concat(F.lit("Station "), "user_id", F.lit(", "), "event_type").alias("start_station_name"),
        F.when(~value.between(0.5, 1), padded).alias("start_station_id"),
        F.lit(None).cast("string").alias("end_station_name"),
        F.lit(None).cast("string").alias("end_station_id"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(coordinate).alias("start_lat"),
        F.concat(F.lit("-"), coordinate).alias("start_lng"),
        F.lit(None).cast("string").alias("end_lat"),
        F.lit(None).cast("string").alias("end_lng"),
        F.when(F.col("event_type").isin("purchase", "signup"), "member").otherwise("casual").alias("member_casual"),
        EVENT_ORDER,
    )


def autumn_rides(spark: SparkSession, folder: str) -> DataFrame:
    """The same rides with every start within three hours before or in the repeated hour of 3 November 2024."""
    base = F.lit("2024-11-03 00:00:00").cast("timestamp_ntz")
    e = table(spark, folder, "events")
    start = F.timestamp_add("SECOND", F.pmod("event_id", F.lit(3 * 3600)).cast("int"), base)
    end = F.timestamp_add("SECOND", F.floor(F.col("value") * 60 + 0.5).cast("int"), start)
    return rides(spark, folder).join(
        e.select("event_id", start.cast("string").alias("_s"), end.cast("string").alias("_e")), EVENT_ORDER
    ).select(*[F.col({"started_at": "_s", "ended_at": "_e"}.get(c, c)).alias(c) for c in rides(spark, folder).columns])


def fraction_rides(spark: SparkSession, folder: str) -> DataFrame:
    """Rides of an hour whose end has a fraction: up to twelve zeros, a number, and text after every fifth."""
    r = rides(spark, folder)
    number = F.pmod(EVENT_ORDER, F.lit(1300)).cast("string")
    zeros = F.expr(f"repeat('0', cast({EVENT_ORDER} % 13 AS int))")
    tail = F.when(F.col(EVENT_ORDER) % 5 == 0, "abc").when(F.col(EVENT_ORDER) % 7 == 0, " ").otherwise("")
    empty = F.col(EVENT_ORDER) % 97 == 0
    fraction = F.when(empty, ".x").otherwise(F.concat(F.lit("."), zeros, number, tail))
    return r.withColumns(
        {"start_station_id": F.lit("1"), "started_at": F.lit("2024-03-05 10:00:00"), "ended_at": F.concat(F.lit("2024-03-05 11:00:00"), fraction)}
    )


def stations(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as stations in the region of their nation."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    joined = table(spark, folder, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.col("s_suppkey").cast("string").alias("start_station_id"),
        F.col("s_name").alias("station_name"),
        F.col("s_acctbal").alias("latitude"),
        (-F.col("s_acctbal")).alias("longitude"),
        F.col("r_name").alias("borough"),
    )


def weather_long(spark: SparkSession, folder: str) -> DataFrame:
    """Events as weather observations; some days lack the low, the 30th both temperatures."""
    e = table(spark, folder, "events")
    day = _shifted(F.col("ts")).cast("date")
    kind = F.col("event_type")
    datatype = (
        F.when(kind == "view", "TMAX").when(kind == "click", "TMIN").when(kind == "error", "PRCP").when(kind == "signup", "SNOW")
    ).otherwise("WSPD")
    missing = (kind.isin("view", "click") & (F.dayofmonth(day) == 30)) | (
        (kind == "click") & F.dayofmonth(day).isin(3, 10, 17, 24)
    )
    return e.select(
        F.date_format(day, "yyyy-MM-dd").alias("date"),
        datatype.alias("datatype"),
        F.when(~missing, F.col("value")).alias("value"),
        EVENT_ORDER,
    )


def weather(spark: SparkSession, folder: str) -> DataFrame:
    return weather_rows(weather_long(spark, folder), F.col(EVENT_ORDER))


def permits(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as permits in the customer's region, spread over the first 28 days of March."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    joined = table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    day = F.date_add(F.lit("2024-03-01").cast("date"), F.pmod("o_orderkey", F.lit(28)).cast("int"))
    hour = F.lpad(F.pmod("o_custkey", F.lit(24)).cast("string"), 2, "0")
    suffix = F.when(F.col("o_orderstatus") == "F", ".000").when(F.col("o_orderstatus") == "O", "Z").otherwise("")
    start = F.concat(day.cast("string"), F.lit("T"), hour, F.lit(":15:00"), suffix)
    return joined.select(
        F.col("o_orderkey").cast("string").alias("event_id"),
        F.lit(None).cast("string").alias("event_name"),
        F.when(F.col("c_acctbal") <= 9500, start).otherwise("").alias("start_date_time"),
        F.lit(None).cast("string").alias("end_date_time"),
        F.lit(None).cast("string").alias("event_agency"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).otherwise(" ").alias("event_type"),
        F.when(F.col("c_acctbal") >= 0, F.col("r_name")).otherwise(" ").alias("event_borough"),
    )


def inputs(spark: SparkSession, folder: str) -> Inputs:
    return Inputs(rides(spark, folder), stations(spark, folder), permits(spark, folder), weather(spark, folder))


def points(spark: SparkSession, folder: str) -> DataFrame:
    """The first two embedding dimensions as positions."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("point_id"),
        F.element_at("embedding", 1).cast("double").alias("longitude"),
        F.element_at("embedding", 2).cast("double").alias("latitude"),
    )


# Test shapes over the range of the embeddings: concave, with a hole, overlapping, multi-part, oblique.
SHAPES = (
    ("Bronx", "Polygon", [[[-0.3, -0.3], [0.0, -0.3], [0.0, 0.0], [-0.15, -0.2], [-0.3, 0.0], [-0.3, -0.3]]]),
    (
        "Brooklyn",
        "Polygon",
        [
            [[0.0, 0.0], [0.25, 0.0], [0.25, 0.25], [0.0, 0.25], [0.0, 0.0]],
            [[0.05, 0.05], [0.05, 0.15], [0.15, 0.15], [0.15, 0.05], [0.05, 0.05]],
        ],
    ),
    ("Manhattan", "Polygon", [[[0.02, -0.2], [0.3, -0.2], [0.3, 0.12], [0.02, 0.12], [0.02, -0.2]]]),
    (
        "Queens",
        "MultiPolygon",
        [
            [[[-0.4, 0.3], [-0.1, 0.3], [-0.25, 0.1], [-0.4, 0.3]]],
            [[[-0.1, 0.02], [-0.02, 0.02], [-0.06, 0.2], [-0.1, 0.02]]],
        ],
    ),
    ("Staten Island", "Polygon", [[[-0.2, -0.15], [-0.05, -0.05], [-0.1, 0.1], [-0.25, 0.0], [-0.2, -0.15]]]),
)


def polygons(spark: SparkSession) -> DataFrame:
    rows = [(i, {"boroname": n}, {"type": kind, "coordinates": json.dumps(c)}) for i, (n, kind, c) in enumerate(SHAPES)]
    features = spark.createDataFrame(
        rows, "pos int, properties map<string,string>, geometry struct<type:string,coordinates:string>"
    ).select("pos", F.struct("properties", "geometry").alias("feature"))
    return polygons_from_features(features, F.col("feature"), F.col("pos"))


def polygon_document(spark: SparkSession) -> DataFrame:
    """The shapes as one FeatureCollection in one line."""
    features = [
        {"type": "Feature", "properties": {"boroname": n}, "geometry": {"type": kind, "coordinates": c}} for n, kind, c in SHAPES
    ]
    return spark.createDataFrame([(json.dumps({"type": "FeatureCollection", "features": features}),)], "value string").coalesce(1)


def _piece() -> Column:
    """The piece an event belongs to, by its id alone; as text, in the order of the ids."""
    number = F.expr(f"{EVENT_ORDER} div {PIECE}") + F.lit(10**14)
    return F.coalesce(F.format_string("%015d", number), F.lit("0")).alias("piece")


def weather_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Observations of each day and piece as one document, in event order; with the piece."""
    rows = weather_long(spark, folder)
    one = F.struct("event_id", F.struct("date", "datatype", "value").alias("r"))
    days = rows.groupBy("date", _piece()).agg(F.array_sort(F.collect_list(one)).alias("all"))
    results = F.transform("all", lambda x: x["r"])
    return days.select(F.to_json(F.struct(F.lit("USW00094728").alias("station"), results.alias("results"))).alias("value"), "piece")


def write_weather(spark: SparkSession, folder: str, path: str) -> None:
    """Each document as a file of its own, below a folder per piece: the order of paths is that of the events of a day."""
    weather_documents(spark, folder).write.partitionBy("piece").option("maxRecordsPerFile", 1).text(path)


def write_permits(df: DataFrame, path: str) -> None:
    """Permit CSV with a comment line before every tenth row."""
    rows = df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in df.columns])
    line = F.concat_ws(",", *[F.concat(F.lit('"'), F.col(c), F.lit('"')) for c in rows.columns])
    tenth = F.col("event_id").cast("long") % 10 == 0
    lines = F.when(tenth, F.concat(F.lit("# note\n"), line)).otherwise(line)
    rows.select(lines.alias("value")).write.text(path)


def permit_files(spark: SparkSession, folder: str):
    """Ledger entries of a permit file that was landed twice, below a root folder."""

    def entries(root: str) -> DataFrame:
        counted = permits(spark, folder).agg(F.count("*").alias("n"))
        values = lambda day: {"source": F.lit("events"), "filename": F.lit("events_202403.csv"), "run_date": F.lit(day), "path": F.lit(f"{root}/{day}/events_202403.csv"), "record_count": F.col("n"), "downloaded_at": F.lit(f"{day}T00:00:00Z")}
        rows = [counted.select(*[values(day).get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER.fields]) for day in ("2024-03-01", "2024-04-01")]
        return rows[0].unionByName(rows[1])

    return entries


def file_entries(spark: SparkSession, folder: str, source: str, filename: Column, run_date: str) -> DataFrame:
    """Ledger entries of the part files below a folder."""
    files = list_files(spark, folder).where(F.col("filename").startswith("part-"))
    values = {"source": F.lit(source), "filename": filename, "run_date": F.lit(run_date), "path": F.col("path"), "size_bytes": F.col("size_bytes"), "downloaded_at": F.lit(f"{run_date}T00:00:00Z")}
    return files.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER.fields])


def _piece_of_path() -> Column:
    return F.regexp_extract("path", "/piece=([0-9]+)/", 1)


def land_rides(spark: SparkSession, rows: DataFrame, root: str, run_date: str, third: int) -> DataFrame:
    """The rides of every third day as one file per piece; their ledger entries. Landed again, a piece has its name again."""
    folder = f"{root}/{run_date}/rides_{third}"
    own = rows.where(F.substring("started_at", 9, 2).cast("int") % 3 == third).withColumn("piece", _piece())
    write_rides(own.drop(EVENT_ORDER).repartition("piece"), folder, "piece")
    return file_entries(spark, folder, RIDES_SOURCE, F.concat(F.lit(f"rides_{third}_"), _piece_of_path(), F.lit(".csv")), run_date)


def land_everything(spark: SparkSession, folder: str, root: str) -> DataFrame:
    """All inputs as landed files; of the days whose number leaves 2 by 3, a fifth of the rides is missing."""
    run_date, all_rides = "2024-05-01", rides(spark, folder)
    some = all_rides.where((F.col(EVENT_ORDER) % 5 != 0) | (F.substring("started_at", 9, 2).cast("int") % 3 != 2))
    entries = [land_rides(spark, some, root, run_date, k) for k in range(3)]
    write_permits(permits(spark, folder), f"{root}/{run_date}/events")
    write_weather(spark, folder, f"{root}/{run_date}/weather")
    entries.append(file_entries(spark, f"{root}/{run_date}/events", EVENTS_SOURCE, F.col("filename"), run_date))
    # Files of different pieces can have the same name.
    entries.append(file_entries(spark, f"{root}/{run_date}/weather", WEATHER_SOURCE, F.concat(_piece_of_path(), F.lit("_"), "filename"), run_date))
    every = entries[0]
    for one in entries[1:]:
        every = every.unionByName(one)
    return every


def known_sources(entries: DataFrame) -> DataFrame:
    """Ledger entries under the names of the ledger; those of ``src7`` keep theirs, which is unknown to it."""
    number = F.regexp_extract("source", "([0-9]+)$", 1).cast("int")
    named = F.element_at(F.array(*[F.lit(s) for s in LEDGER_SOURCES]), F.pmod(number, F.lit(len(LEDGER_SOURCES))) + 1)
    return entries.withColumn("source", F.when(F.col("source") == "src7", F.col("source")).otherwise(named))


def _file_name(doc: Column) -> Column:
    return F.concat(F.lit("doc_"), F.lpad(doc.cast("string"), 12, "0"))


def expected_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as a file that should be landed."""
    return table(spark, folder, "documents").select(
        "source", _file_name(F.col("doc_id")).alias("filename"), F.lit("current").alias("dataset_id")
    )


def _entry(run_date: Column, size: Column, dataset: Column, landed_at: Column) -> list[Column]:
    values = {
        "source": F.col("source"),
        "filename": _file_name(F.col("doc_id")),
        "run_date": run_date,
        "path": F.concat(F.lit("/raw/"), "source", F.lit("/"), run_date, F.lit("/"), _file_name(F.col("doc_id"))),
        "size_bytes": size.cast("bigint"),
        "dataset_id": dataset,
        "downloaded_at": landed_at,
    }
    return [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER.fields]


def landed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents as ledger entries: quality 0 landed empty, toxic ones came from an old dataset."""
    joined = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    day = F.lit("2024-01-01")
    dataset = F.when(F.col("toxic") == 1, "previous").when(F.col("lang") == "en", "current")
    return joined.select(*_entry(day, F.col("n_chars") * F.col("quality"), dataset, F.concat(day, F.lit("T00:00:00Z"))))


def documents_run(spark: SparkSession, folder: str) -> DataFrame:
    """A later run that landed every document twice, the second time complete."""
    docs = table(spark, folder, "documents")
    day = F.lit("2024-02-01")
    first = docs.select(*_entry(day, F.lit(0), F.lit("current"), F.concat(day, F.lit("T01:00:00Z"))))
    second = docs.select(
        *_entry(day, F.octet_length("text"), F.lit("current"), F.concat(day, F.lit("T02:00:00Z")))
    )
    return first.unionByName(second)


def document_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes that the source gives: characters, which differ from bytes where a text is not ASCII."""
    return table(spark, folder, "documents").select("source", _file_name(F.col("doc_id")).alias("filename"), F.col("n_chars").alias("size_bytes"))


def document_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of every document under its file name."""
    lines = F.explode(F.split("text", "\n", -1)).alias("line")
    return table(spark, folder, "documents").select(_file_name(F.col("doc_id")).alias("filename"), lines)


def document_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Texts under the paths that ``documents_run`` lands them at."""
    name = _file_name(F.col("doc_id"))
    return table(spark, folder, "documents").select(F.concat(F.lit("/raw/"), "source", F.lit("/2024-02-01/"), name).alias("path"), "text")


def ride_files(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as rows of monthly part files, one part per status."""
    month = F.date_format("o_orderdate", "yyyyMM")
    return table(spark, folder, "orders").select(
        "o_orderkey", F.concat(month, F.lit("-part_"), "o_orderstatus", F.lit(".csv")).alias("filename")
    )


def ingest_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as single-file results of landing runs."""
    value = F.col("value").cast("decimal(12,2)")
    return table(spark, folder, "events").select(
        F.col("event_type").alias("source"),
        F.when(value >= 10, 1).otherwise(0).cast("bigint").alias("new_files"),
        F.when(value < 10, 1).otherwise(0).cast("bigint").alias("skipped_files"),
        F.floor(value * 100).cast("bigint").alias("bytes_pulled"),
        F.when(value < 0.2, 1).otherwise(0).cast("bigint").alias("errors"),
        F.when(value >= 300, 2).otherwise(0).cast("bigint").alias("retries"),
    )


def weather_json(spark: SparkSession, folder: str) -> DataFrame:
    """Observations as JSON documents in a text column."""
    rows = weather_long(spark, folder)
    result = F.struct("date", "datatype", "value")
    document = F.struct(F.lit("USW00094728").alias("station"), F.array(result).alias("results"))
    return rows.select(EVENT_ORDER, F.to_json(document).alias("document"))
