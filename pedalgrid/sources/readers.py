"""Raw inputs as DataFrames. Schemas are explicit; nothing is inferred."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalgrid.schemas import (
    CORRUPT,
    EVENTS_RAW,
    LEDGER,
    LEDGER_SOURCES,
    MANIFEST,
    POLYGON_DOCUMENT,
    POLYGON_FEATURE,
    RIDES_RAW,
    STAGE_TABLES,
    STATIONS,
    UNKNOWN_BOROUGH,
    WEATHER_DOCUMENT,
)

LOAD_ORDER = "load_order"


def load_order() -> Column:
    """Total order of rows by file, block within the file, row within the block.

    Row numbers only ever compare inside one block, so the order does not depend on how Spark packs
    blocks into tasks.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _lines_as_csv(spark: SparkSession, path, schema, **options) -> DataFrame:
    # With column pruning on, the parser does not see missing fields and never reports a short row.
    return (
        spark.read.schema(schema.add(CORRUPT, "string") if CORRUPT not in schema.names else schema)
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", "false")
        .options(**options)
        .csv(path)
    )


def _copy(schema):
    return type(schema)(list(schema.fields))


def short_row(last: str, width: int) -> Column:
    """True for a line with fewer than ``width`` fields; extra fields are accepted."""
    outside_quotes = F.regexp_replace(F.col(CORRUPT), r'"(?:[^"]|"")*"', "")
    commas = F.length(outside_quotes) - F.length(F.replace(outside_quotes, F.lit(",")))
    return F.coalesce(F.col(CORRUPT).isNotNull() & F.col(last).isNull() & (commas < width - 1), F.lit(False))


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Path, name and size of every file below ``path``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("filename"), F.col("length").alias("size_bytes"))


def first_parts(files: DataFrame, name: str = "filename") -> DataFrame:
    """Sample mode: of the part files ``YYYYMM...`` of each month, the first by name.

    A file that lies in several run folders is taken from the last of them, if ``files`` has paths.
    """
    first = files.groupBy(F.substring(name, 1, 6).alias("month")).agg(F.min(name).alias(name))
    picked = files.join(first.select(name), name, "left_semi")
    if "path" not in files.columns:
        return picked
    rest = [c for c in files.columns if c != name]
    return picked.groupBy(name).agg(F.max_by(F.struct(*rest), "path").alias("_f")).select(*[name if c == name else f"_f.{c}" for c in files.columns])


def read_rides(spark: SparkSession, path: str | list[str], month: str | None = None, sample: bool = False) -> DataFrame:
    """Ride CSV parts as one table, with the unparsed text of rows that do not have thirteen fields.

    ``month`` (``YYYY-MM`` or ``YYYYMM``) is a prefix of the file name and prunes at listing time.
    ``sample`` keeps the first part file of each month.
    """
    source: str | list[str] = path
    if month and not isinstance(path, str):
        prefix = month.replace("-", "")
        source = [p for p in path if p.rsplit("/", 1)[-1].startswith(prefix)]
    elif month:
        source = f"{path.rstrip('/')}/{month.replace('-', '')}*"
    if sample:
        # One path per month reaches the driver, as a file list does for every read.
        source = [row.path for row in first_parts(list_files(spark, source)).select("path").collect()]
    rows = _lines_as_csv(spark, source, _copy(RIDES_RAW))
    return rows.filter(~F.coalesce(F.col("ride_id").startswith("ride_id"), F.lit(False)))


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """Station lookup; padded values are trimmed and the last row of an id wins."""
    rows = _lines_as_csv(spark, path, type(STATIONS)([f for f in _text_fields(STATIONS)]))
    rows = rows.withColumn(LOAD_ORDER, load_order())
    rows = rows.filter(~short_row("borough", 5) & (F.col("start_station_id") != "start_station_id"))
    last = rows.groupBy(F.trim("start_station_id").alias("start_station_id")).agg(
        F.max_by(F.struct("station_name", "latitude", "longitude", "borough"), LOAD_ORDER).alias("r")
    )
    return last.select(
        "start_station_id",
        F.trim("r.station_name").alias("station_name"),
        F.col("r.latitude").try_cast("double").alias("latitude"),
        F.col("r.longitude").try_cast("double").alias("longitude"),
        F.coalesce(F.trim("r.borough"), F.lit("")).alias("borough"),
    )


def _text_fields(schema):
    string = RIDES_RAW["ride_id"].dataType
    return [type(f)(f.name, string, True) for f in schema.fields]


def read_events(spark: SparkSession, path) -> DataFrame:
    """Permit CSV files below ``path``; comment lines and headers are skipped."""
    rows = _lines_as_csv(spark, path, _copy(EVENTS_RAW), comment="#", recursiveFileLookup="true")
    return rows.filter(~F.coalesce(F.col("event_id").startswith("event_id"), F.lit(False)))


def read_weather(spark: SparkSession, path, pattern: str = "*.json") -> DataFrame:
    """Weather documents as long rows (date, datatype, value) with their load order."""
    documents = (
        spark.read.schema(WEATHER_DOCUMENT)
        .option("multiLine", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .json(path)
    )
    rows = documents.select(F.col("_metadata.file_path").alias("file"), F.posexplode("results").alias("row", "r"))
    return weather_rows(rows.select("file", "row", "r.*"), F.struct("file", "row"))


def weather_rows(rows: DataFrame, order: Column) -> DataFrame:
    """Complete observations only; the date is the first ten characters."""
    complete = rows.filter(F.col("date").isNotNull() & F.col("datatype").isNotNull() & F.col("value").isNotNull())
    day = F.substring("date", 1, 10).try_cast("date")
    return complete.select(day.alias("date"), "datatype", "value", order.alias(LOAD_ORDER))


def json_observations(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """Weather documents held in a string column, one row per element of ``results``."""
    parsed = df.select(*keep, F.from_json(text, WEATHER_DOCUMENT).alias("doc"))
    return parsed.select(*keep, F.posexplode("doc.results").alias("row", "r")).select(*keep, "row", "r.*")


def read_stage(spark: SparkSession, name: str, path: str, fmt: str = "parquet", min_fields: int | None = None) -> DataFrame:
    """A stage table. Tab-separated rows keep trailing empty fields.

    Rows with fewer than ``min_fields`` fields (all of them, if not given) are skipped; fields that
    are absent or not of their type are null.
    """
    schema = STAGE_TABLES[name]
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    rows = spark.read.text(path).select(F.split("value", "\t", -1).alias("f"))
    rows = rows.filter(F.size("f") >= (min_fields or len(schema)))
    texts = rows.select(*[F.get("f", F.lit(i)).alias(field.name) for i, field in enumerate(schema.fields)])
    return texts.select(
        *[
            F.col(f.name) if f.dataType.typeName() == "string" else F.nullif(f.name, F.lit("")).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    """Borough polygons of a FeatureCollection or a bare feature list: ``poly_order, name, parts``.

    ``parts`` is an array of polygons, each an array of rings, each an array of ``[x, y]`` points.
    """
    schema = POLYGON_DOCUMENT
    for field in POLYGON_FEATURE.fields:
        if field.name not in schema.names:
            schema = type(schema)(schema.fields + [field])
    documents = spark.read.schema(schema).option("multiLine", "true").json(path)
    # A bare list arrives as one row per feature, in file order.
    as_list = F.coalesce("features", F.array(F.struct("properties", "geometry")))
    features = documents.withColumn("doc", F.monotonically_increasing_id()).select(
        "doc", F.posexplode(as_list).alias("pos", "feature")
    )
    polygons = polygons_from_features(features, F.col("feature"), F.struct("doc", "pos"))
    if polygons.isEmpty():
        raise ValueError(f"no polygons in {path}")
    return polygons


def polygons_from_features(features: DataFrame, feature: Column, order: Column) -> DataFrame:
    names = [F.nullif(feature["properties"].getItem(k), F.lit("")) for k in ("boroname", "boro_name", "BoroName", "borough")]
    text = feature["geometry"]["coordinates"]
    # A polygon is read as a multi-polygon of one part.
    nested = F.when(feature["geometry"]["type"] == "Polygon", F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    parts = F.from_json(nested, "array<array<array<array<double>>>>")
    return features.filter(text.isNotNull()).select(
        order.alias("poly_order"), F.coalesce(*names, F.lit(UNKNOWN_BOROUGH)).alias("name"), parts.alias("parts")
    )


def read_ledger(spark: SparkSession, path: str | None, fmt: str = "parquet") -> DataFrame:
    """The newest snapshot of the file ledger, empty if there is none yet; unknown sources are ignored.

    ``fmt="manifest"`` takes the nested JSON document ``{sources: {source: {filename: entry}}}``.
    """
    empty = spark.createDataFrame([], LEDGER)
    if path is None:
        return empty
    nested = fmt == "manifest"
    reader = spark.read.schema(MANIFEST if nested else LEDGER).option("mode", "FAILFAST").option("multiLine", nested)
    try:
        if not nested:
            # History grows without end: names are listed, and only the newest snapshot is opened.
            folders = list_files(spark, path).select(F.regexp_extract("path", r"/(snapshot=[^/]+)/[^/]+$", 1).alias("folder"))
            newest = folders.agg(F.max("folder")).first()[0]
            path = f"{path.rstrip('/')}/{newest}" if newest else path
        loaded = reader.format("json" if nested else fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise
    if nested:
        files = loaded.select(F.explode("sources").alias("source", "files")).select("source", F.explode("files").alias("filename", "e"))
        loaded = files.select("source", "filename", "e.*").withColumnRenamed("hdfs_path", "path").select(*LEDGER.names)
    return known(loaded.select(*LEDGER.names))


def known(entries: DataFrame) -> DataFrame:
    """Ledger entries less those of unknown sources."""
    return entries.filter(F.col("source").isin(*LEDGER_SOURCES))


def latest(ledger: DataFrame, source: str, by: str = "filename") -> DataFrame:
    """Newest landed dataset of a source: the top entry by name, or by ``run_date``."""
    return ledger.filter(F.col("source") == source).orderBy(F.col(by).desc(), F.col("filename").desc()).limit(1)


def smoke_range(spark: SparkSession, n: int = 1_000_000, modulus: int = 7) -> DataFrame:
    """Cluster smoke query: how many of ``n`` numbers are divisible."""
    return count_divisible(spark.range(n), "id", modulus)


def count_divisible(df: DataFrame, column: str, modulus: int) -> DataFrame:
    return df.filter(F.col(column) % modulus == 0).agg(F.count("*").alias("n"))
