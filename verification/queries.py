"""One query per operator; every query reads whole warehouse tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pedalgrid.functions import measures as m
from pedalgrid.functions.timeparse import month_bounds
from pedalgrid.operators import cells, checks, clean, daily, enrich, geo, ledger, regress, stats
from pedalgrid.plans import demand, incremental
from pedalgrid.schemas import DEMAND_QUANTILES
from pedalgrid.session import scratch_path, staged
from pedalgrid.sources import files, readers, snapshots, writers
from verification import warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the number type both engines print alike."""
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema]
    )


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, folder: plain(fn(spark, folder))
    return fn


def _tagged(spark, d):
    return clean.tag_rides(warehouse.rides(spark, d))


def _lookup(spark, d):
    return demand.measured_lookup(warehouse.stations(spark, d))


def _t1(spark, d):
    return clean.clean_rides(warehouse.rides(spark, d), _lookup(spark, d))


def _t2(spark, d):
    return demand.daily_table(warehouse.inputs(spark, d))


def _tables(spark, d):
    return demand.demand_tables(warehouse.inputs(spark, d))


# --- rides and permits ------------------------------------------------------------------------


@query
def rides_tagged(spark, d):
    return _tagged(spark, d).select("ride_id", "duration_ms", "decision")


@query
def rides_autumn(spark, d):
    """All rides moved to the days around the night on which an hour is shown twice."""
    return clean.tag_rides(warehouse.autumn_rides(spark, d)).select("ride_id", "duration_ms", "decision")


@query
def fractions(spark, d):
    """Fractions of any length, with leading zeros and with text behind them."""
    return clean.tag_rides(warehouse.fraction_rides(spark, d)).select("ride_id", "duration_ms")


@query
def quality_counts(spark, d):
    return clean.quality_counts(_tagged(spark, d))


@query
def assign_borough(spark, d):
    trimmed = warehouse.rides(spark, d).withColumn("start_station_id", F.trim("start_station_id"))
    return clean.assign_borough(trimmed, _lookup(spark, d)).select("ride_id", "borough")


@query
def clean_rides(spark, d):
    return _t1(spark, d)


@query
def daily_rides(spark, d):
    return daily.daily_rides(_t1(spark, d))


@query
def events_tagged(spark, d):
    return clean.tag_events(warehouse.permits(spark, d)).select("event_id", "date", "borough", "type", "decision")


@query
def event_quality_counts(spark, d):
    return clean.event_quality_counts(warehouse.permits(spark, d))


@query
def daily_events(spark, d):
    return daily.daily_events(clean.clean_events(warehouse.permits(spark, d)))


# --- weather ----------------------------------------------------------------------------------


@query
def json_inline(spark, d):
    rows = readers.json_observations(warehouse.weather_json(spark, d), "document", warehouse.EVENT_ORDER)
    return readers.weather_rows(rows, F.col(warehouse.EVENT_ORDER)).withColumnRenamed(readers.LOAD_ORDER, "event_id")


@query
def weather_pivot(spark, d):
    return daily.pivot_weather(warehouse.weather(spark, d))


@query
def temp_fallback(spark, d):
    return daily.daily_weather(daily.pivot_weather(warehouse.weather(spark, d)))


@query
def daily_join(spark, d):
    return _t2(spark, d)


# --- statistics -------------------------------------------------------------------------------


@query
def borough_stats(spark, d):
    return stats.borough_stats(_t2(spark, d))


@query
def quantile_floor(spark, d):
    return stats.quantile_floor(_t1(spark, d), ["borough"], "ride_duration_min", DEMAND_QUANTILES)


@query
def event_thresholds(spark, d):
    return stats.event_thresholds(_t2(spark, d))


@query
def ols_moments(spark, d):
    return regress.ols_moments(_t2(spark, d))


@query
def ols_fit(spark, d):
    return regress.fit_ols(_t2(spark, d))


@query
def ols_counters(spark, d):
    return regress.fit_counters(_t2(spark, d))


# --- enrichment -------------------------------------------------------------------------------


def _measure(spark, d, name, *inputs):
    t = _tables(spark, d)
    rows = enrich.with_statistics(t.t2, t.t3a, t.t3b, t.t3c)
    value = getattr(m, "is_anomaly" if name == "anomaly" else name)(*[F.col(c) for c in inputs])
    return rows.select("date", "borough", value.alias(name))


@query
def expected_rides(spark, d):
    betas = ("beta0", "beta1_temp", "beta2_precip", "beta3_snow")
    return _measure(spark, d, "expected_rides", *betas, "temp", "precip", "snow")


@query
def event_intensity(spark, d):
    return _measure(spark, d, "event_intensity", "event_count", "p33", "p66")


@query
def anomaly_flag(spark, d):
    return _measure(spark, d, "anomaly", "total_rides", "mean", "stddev")


@query
def demand_level(spark, d):
    return _measure(spark, d, "demand_level", "total_rides", "q20", "q40", "q60", "q80")


@query
def enriched_w(spark, d):
    return demand.daily_demand(warehouse.inputs(spark, d))


@query
def incremental_w(spark, d):
    """Every third day lands incomplete and later again, whole: those days alone are written anew."""
    root = scratch_path(spark, "incremental")
    files = warehouse.land_everything(spark, d, f"{root}/raw")
    options = {"period": "yyyyMMdd", "weather_pattern": "*.txt"}
    incremental.refresh(spark, files, warehouse.stations(spark, d), f"{root}/out", **options)
    files = files.unionByName(warehouse.land_rides(spark, warehouse.rides(spark, d), f"{root}/raw", "2024-06-01", 2))
    done = incremental.refresh(spark, files, warehouse.stations(spark, d), f"{root}/out", **options)
    counts = {name: F.lit(len(done.periods[source])).cast("bigint") for name, source in (("rewritten", "citibike"), ("other", "events"))}
    return done.w.withColumns(counts)


def _state(spark, d):
    """Sums per third of the days and borough, and those of one third with twice the rides."""
    t2 = _t2(spark, d).withColumn("third", (F.dayofmonth("date") % 3).cast("string"))
    state = staged(regress.period_moments(t2, "third"), "moments")
    wrong = t2.where("third = '2'").withColumn("total_rides", F.col("total_rides") * 2)
    return state, regress.period_moments(wrong, "third")


@query
def ols_from_state(spark, d):
    """A third of the days is first added wrong, then withdrawn and added right; T2 is not read for the fit."""
    state, wrong = _state(spark, d)
    wrong = staged(wrong, "wrong")
    totals = staged(regress.combined_moments(state.where("third <> '2'"), wrong), "totals")
    return regress.fit_moments(regress.combined_moments(totals, state.where("third = '2'"), withdrawn=wrong))


@query
def ols_withdrawn(spark, d):
    """The fit without a third of the days, taken back from the sums of all."""
    state, _ = _state(spark, d)
    totals = staged(regress.combined_moments(state), "totals")
    return regress.fit_moments(regress.combined_moments(totals, withdrawn=state.where("third = '2'")))


# --- stations ---------------------------------------------------------------------------------


@query
def unique_stations(spark, d):
    return geo.unique_stations(warehouse.rides(spark, d), warehouse.EVENT_ORDER)


def _located(spark, d):
    return geo.point_in_polygon(warehouse.points(spark, d), demand.measured_bands(warehouse.polygons(spark)))


@query
def point_in_polygon(spark, d):
    return _located(spark, d)


@query
def point_in_cells(spark, d):
    """The same points through the grid: only those in cells with edges meet edges."""
    return cells.point_in_cells(warehouse.points(spark, d), demand.measured_cells(warehouse.polygons(spark)))


@query
def repeated_points(spark, d):
    """Positions without their ids, each of them twice: every row keeps its row."""
    xy = warehouse.points(spark, d).select("longitude", "latitude")
    return geo.point_in_polygon(xy.unionAll(xy), demand.measured_bands(warehouse.polygons(spark)))


@query
def polygons_file(spark, d):
    """Polygons through a file and the real reader, points of the table located in them."""
    path = scratch_path(spark, "polygons")
    warehouse.polygon_document(spark).write.text(path)
    return geo.point_in_polygon(warehouse.points(spark, d), demand.measured_bands(readers.read_polygons(spark, path)))


def _landed_rides(spark, d):
    path = scratch_path(spark, "rides")
    writers.write_rides(warehouse.rides(spark, d).drop(warehouse.EVENT_ORDER), path)
    return path


@query
def build_stations(spark, d):
    """Station lookup from ride files in load order, written and read back, with the count outside all polygons."""
    # One file per run keeps the order of the events in the order of the files.
    path = scratch_path(spark, "rides")
    ordered = warehouse.rides(spark, d).repartitionByRange(4, warehouse.EVENT_ORDER).sortWithinPartitions(warehouse.EVENT_ORDER)
    writers.write_rides(ordered.drop(warehouse.EVENT_ORDER), path)
    rides = readers.read_rides(spark, path).withColumn(readers.LOAD_ORDER, readers.load_order())
    # Ride coordinates spread over hundreds of units, the test shapes over one.
    near = rides.withColumns({c: (F.col(c).try_cast("double") / 1000).cast("string") for c in ("start_lat", "start_lng")})
    built = demand.write_station_lookup(near, warehouse.polygons(spark), scratch_path(spark, "stations"))
    return built.stations.withColumn("outside", F.lit(built.outside.first()["outside"]).cast("bigint"))


@query
def borough_counts(spark, d):
    return geo.borough_counts(_located(spark, d))


@query
def unmatched_points(spark, d):
    return geo.unmatched(_located(spark, d))


# --- ledger -----------------------------------------------------------------------------------


@query
def expected_files(spark, d):
    month = F.date_format("o_orderdate", "yyyyMM")
    span = warehouse.table(spark, d, "orders").agg(F.min(month).alias("first"), F.max(month).alias("last"))
    return ledger.expected_files(span)


@query
def pending_files(spark, d):
    return ledger.pending_files(warehouse.expected_documents(spark, d), warehouse.landed_documents(spark, d))


@query
def ledger_upsert(spark, d):
    return ledger.upsert_ledger(warehouse.landed_documents(spark, d), warehouse.documents_run(spark, d))


@query
def current_paths(spark, d):
    both = warehouse.landed_documents(spark, d).unionByName(warehouse.documents_run(spark, d))
    return ledger.current_paths(both, "src7")


@query
def size_reconcile(spark, d):
    docs = warehouse.table(spark, d, "documents").withColumn("filename", F.col("doc_id").cast("string"))
    landed = docs.select("source", "filename", F.octet_length("text").cast("bigint").alias("size_bytes"))
    return ledger.reconcile_sizes(landed, docs.select("source", "filename", F.col("n_chars").alias("size_bytes")))


@query
def ingest_summary(spark, d):
    return ledger.ingest_summary(warehouse.ingest_log(spark, d))


@query
def ingest_plan(spark, d):
    _, summary = demand.plan_ingest(warehouse.expected_documents(spark, d), warehouse.landed_documents(spark, d))
    return summary


def _ingest(spark, d):
    return demand.run_ingest(
        warehouse.expected_documents(spark, d),
        warehouse.landed_documents(spark, d),
        warehouse.documents_run(spark, d),
        warehouse.document_sizes(spark, d),
        ledger.records_per_file(warehouse.document_lines(spark, d), "filename"),
        ledger.fingerprint(warehouse.document_paths(spark, d), "text"),
    )


@query
def ingest_mismatched(spark, d):
    return _ingest(spark, d).mismatched.select("source", "filename", "size_bytes", "source_bytes")


@query
def ingest_ledger(spark, d):
    """The ledger after a run: sizes, hashes and record counts of the files that were due and whole."""
    return _ingest(spark, d).ledger


@query
def ingest_totals(spark, d):
    done = _ingest(spark, d)
    return done.summary.withColumn("entries", F.lit(done.entries.first()["entries"]).cast("bigint"))


@query
def fingerprint_files(spark, d):
    """Pages as sixteen files, hashed by reading the files."""
    path = scratch_path(spark, "pages")
    pages = warehouse.table(spark, d, "pages").select(F.pmod("page_id", F.lit(16)).alias("g"), "page_id", "html")
    pages.repartition(4, "g").sortWithinPartitions("g", "page_id").drop("page_id").write.partitionBy("g").text(path)
    group = F.regexp_extract("path", "/g=([0-9]+)/", 1).cast("bigint").alias("g")
    return ledger.fingerprint_files(spark, path).select(group, "size_bytes", "sha256")


@query
def ledger_size(spark, d):
    return ledger.ledger_size(warehouse.landed_documents(spark, d))


@query
def fingerprint(spark, d):
    return ledger.fingerprint(warehouse.table(spark, d, "pages").select("page_id", "html"), "html")


@query
def ledger_snapshots(spark, d):
    """Two snapshots are written; the newest is read, unknown sources left out."""
    root = scratch_path(spark, "ledger")
    old = warehouse.known_sources(warehouse.landed_documents(spark, d))
    writers.write_ledger(old, root)
    writers.write_ledger(ledger.upsert_ledger(readers.read_ledger(spark, root), warehouse.known_sources(warehouse.documents_run(spark, d))), root)
    return readers.read_ledger(spark, root)


@query
def ledger_commits(spark, d):
    """Two runs add to the ledger from one version: the second one is overtaken, reads again, and both runs are in it."""
    root = scratch_path(spark, "commits")
    ledger.commit_run(spark, root, warehouse.known_sources(warehouse.landed_documents(spark, d)))
    run = warehouse.known_sources(warehouse.documents_run(spark, d))
    even = F.substring("filename", -1, 1).cast("int") % 2 == 0
    overtaken = []

    def change(old):
        if not overtaken:
            overtaken.append(ledger.commit_run(spark, root, run.where(even)))
        return ledger.upsert_ledger(old, run.where(~even))

    snapshots.commit(spark, root, readers.LEDGER, change)
    return readers.known(ledger.committed_ledger(spark, root))


@query
def landed_twice(spark, d):
    """Permits of one file in two run folders: through the ledger they count once."""
    root, files = scratch_path(spark, "permits"), warehouse.permit_files(spark, d)
    for run_date in ("2024-03-01", "2024-04-01"):
        warehouse.write_permits(warehouse.permits(spark, d), f"{root}/{run_date}/events_202403.csv")
    paths = demand.landed_paths(files(root), "events")
    return daily.daily_events(clean.clean_events(readers.read_events(spark, paths)))


@query
def records_per_file(spark, d):
    return ledger.records_per_file(warehouse.ride_files(spark, d), "filename")


@query
def latest_dataset(spark, d):
    return readers.latest(warehouse.landed_documents(spark, d), "src7").select("source", "filename", "size_bytes")


@query
def sample_parts(spark, d):
    return readers.first_parts(warehouse.ride_files(spark, d))


# --- slices and checks ------------------------------------------------------------------------


@query
def month_slice(spark, d):
    return checks.month_slice(warehouse.table(spark, d, "orders"), "o_orderdate", "199806").select(
        "o_orderkey", "o_orderdate", "o_totalprice"
    )


@query
def event_page(spark, d):
    listing = checks.month_slice(warehouse.table(spark, d, "events"), "ts", "202401")
    return checks.page(listing.select("ts", "event_id", "event_type"), ["ts", "event_id"], limit=50, offset=100)


@query
def event_page_deep(spark, d):
    """The last page but one hundred rows, through an index of page starts."""
    events = warehouse.table(spark, d, "events").select("ts", "event_id", "event_type")
    index = checks.page_index(events, ["ts", "event_id"], rows_per_file=5_000)
    return index.page(index.rows - 100, 50)


@query
def spot_check(spark, d):
    return checks.spot_check(_t2(spark, d), "2024-03-15", "ASIA")


@query
def preview(spark, d):
    return checks.preview(daily.daily_rides(_t1(spark, d)), ["date", "borough"])


@query
def compare_counts(spark, d):
    rides, permits = _tagged(spark, d), clean.tag_events(warehouse.permits(spark, d))
    return checks.compare_counts(
        rides.groupBy("decision").agg(F.count("*").alias("n")), permits.groupBy("decision").agg(F.count("*").alias("n"))
    )


@query
def compare_tables(spark, d):
    placed = warehouse.table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"))
    return checks.compare_tables(placed, warehouse.table(spark, d, "customer").select(F.col("c_custkey").alias("custkey")))


@query
def table_parity(spark, d):
    inputs = warehouse.inputs(spark, d)
    direct = daily.daily_rides_from_kept(clean.kept_rides(inputs.rides), _lookup(spark, d))
    return checks.compare_tables(daily.daily_rides(_t1(spark, d)), direct)


@query
def parity_fingerprint(spark, d):
    """Orders against a copy with changed prices, missing states and repeated rows, found by fingerprints."""
    orders = warehouse.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    key = F.col("o_orderkey")
    copies = F.when(key % 1009 == 0, 3).otherwise(1)
    changed = orders.select(
        "o_orderkey",
        F.when(key % 991 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 997 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
    )
    return checks.compare_by_fingerprint(orders, changed.drop("copy"))


@query
def check_grain(spark, d):
    return checks.check_grain(warehouse.table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@query
def row_counts(spark, d):
    return checks.row_counts({name: warehouse.table(spark, d, name) for name in warehouse.TABLES})


@query
def divisible_events(spark, d):
    return readers.count_divisible(warehouse.table(spark, d, "events"), "event_id", 7)


# --- round trips through files ----------------------------------------------------------------


@query
def csv_roundtrip(spark, d):
    path = scratch_path(spark, "rides")
    writers.write_rides(warehouse.rides(spark, d).drop(warehouse.EVENT_ORDER), path)
    return clean.tag_rides(readers.read_rides(spark, path)).select("ride_id", "duration_ms", "decision")


@query
def rides_month(spark, d):
    """Ride files of several months; one month is listed and read."""
    path = scratch_path(spark, "months")
    rides = warehouse.rides(spark, d).drop(warehouse.EVENT_ORDER)
    for month in ("202403", "202404"):
        dashed = f"{month[:4]}-{month[4:]}"
        writers.write_rides(rides.where(F.col("started_at").startswith(dashed)), f"{path}/{month}-tripdata.csv")
    return clean.tag_rides(readers.read_rides(spark, path, month="2024-03")).select("ride_id", "decision")


@query
def rides_sample(spark, d):
    """Part files of two run folders; of each month the first part is read, from the later folder."""
    path = scratch_path(spark, "sample")
    rides = warehouse.rides(spark, d).withColumn("third", F.col(warehouse.EVENT_ORDER) % 3)
    for run, part, third in (("run=a", 1, 0), ("run=a", 2, 1), ("run=b", 1, 2)):
        folder = f"{path}-written/{run}-{part}"
        writers.write_rides(rides.where(F.col("third") == third).drop("third", warehouse.EVENT_ORDER).coalesce(1), folder)
        files.move(spark, files.part_files(spark, folder)[0], f"{path}/{run}/202403-trips_{part}.csv")
    return clean.tag_rides(readers.read_rides(spark, f"{path}/*", sample=True)).select("ride_id", "decision")


@query
def events_roundtrip(spark, d):
    """Permits in two run folders, with comment lines between the rows."""
    path = scratch_path(spark, "permits")
    permits = warehouse.permits(spark, d)
    late = F.col("event_id").cast("long") % 3 == 0
    warehouse.write_permits(permits.where(late), f"{path}/run=b")
    warehouse.write_permits(permits.where(~late), f"{path}/run=a")
    tagged = clean.tag_events(readers.read_events(spark, path))
    return tagged.select("event_id", "date", "borough", "type", "decision")


@query
def weather_files(spark, d):
    """Weather documents as files of their own."""
    path = scratch_path(spark, "weather")
    warehouse.write_weather(spark, d, path)
    return daily.pivot_weather(readers.read_weather(spark, path, pattern="*.txt"))


@query
def export_roundtrip(spark, d):
    """The report layout, in parts and as one file, read back in order."""
    path, t2 = scratch_path(spark, "export"), _t2(spark, d)
    parts = []
    for name, single in (("parts", False), ("single", True)):
        writers.export_tsv(t2, f"{path}/{name}", ["date", "borough"], single_file=single)
        read = spark.read.schema(readers.STAGE_TABLES["T2"]).option("header", "true").option("sep", "\t").csv(f"{path}/{name}")
        place = F.row_number().over(Window.orderBy("_metadata.file_path", F.monotonically_increasing_id())).cast("bigint")
        parts.append(read.select(F.lit(name).alias("layout"), place.alias("place"), "date", "borough", "total_rides", "temp"))
    return parts[0].unionByName(parts[1])


@query
def tsv_roundtrip(spark, d):
    path = scratch_path(spark, "T2")
    writers.write_stage(_t2(spark, d), "T2", path, "text")
    return readers.read_stage(spark, "T2", path, "text")


@query
def stations_roundtrip(spark, d):
    path = scratch_path(spark, "stations")
    writers.write_stations(warehouse.stations(spark, d), path)
    return readers.read_stations(spark, path)


@query
def stage_counters(spark, d):
    """Counters observed while T1 is written, next to the rows that reached the table."""
    path = scratch_path(spark, "T1")
    counters = demand.write_clean_rides(warehouse.rides(spark, d), warehouse.stations(spark, d), path)
    written = readers.read_stage(spark, "T1", path).agg(F.count("*").alias("t1_rows"))
    return written.select(*[F.lit(n).cast("bigint").alias(label) for label, n in counters.items()], "t1_rows")


@query
def exact_counters(spark, d):
    """Counters read from the committed files, next to the rows of T1."""
    path = scratch_path(spark, "T1")
    counters = demand.write_counted_rides(warehouse.rides(spark, d), warehouse.stations(spark, d), path)
    written = readers.read_stage(spark, "T1", path).agg(F.count("*").alias("t1_rows"))
    return written.select(*[F.lit(n).cast("bigint").alias(label) for label, n in counters.items()], "t1_rows")


def _as_texts(df: DataFrame) -> DataFrame:
    """Decimals as text with all their digits, next to their types."""
    decimals = [f for f in df.schema if f.dataType.typeName() == "decimal"]
    texts = {f.name: F.col(f.name).cast("string") for f in decimals}
    return df.select(*df.columns, *[F.lit(f.dataType.simpleString()).alias(f"{f.name}_type") for f in decimals]).withColumns(texts)


@query
def exact_t2(spark, d):
    return _as_texts(_t2(spark, d))


@query
def exact_fit(spark, d):
    return _as_texts(regress.fit_ols(_t2(spark, d)))


@query
def exact_stats(spark, d):
    return _as_texts(stats.borough_stats(_t2(spark, d)))


# --- scalar functions -------------------------------------------------------------------------


@query
def text_functions(spark, d):
    """Trim, substring, prefix and suffix tests, length, split, join and hash over whole texts."""
    text = F.col("text")
    words = F.split(text, " ", -1)
    return warehouse.table(spark, d, "documents").select(
        "doc_id",
        F.length(F.trim(text)).cast("bigint").alias("trimmed"),
        F.substring(text, 1, 10).alias("first10"),
        F.startswith(text, F.lit("T")).alias("prefixed"),
        F.regexp_replace(text, r"[.]$", "").endswith(".").alias("suffixed"),
        F.size(words).cast("bigint").alias("n_words"),
        F.sha2(F.concat_ws("\t", words[0], "lang", "source"), 256).alias("joined_sha"),
    )


@query
def number_functions(spark, d):
    """Formatting, tolerant casts, abs, sqrt with clamp, floor, bounds, defaults and modulo."""
    value = F.col("value")
    return warehouse.table(spark, d, "events").select(
        "event_id",
        F.format_string("%.2f", value).alias("two"),
        F.format_string("%.4f", value).alias("four"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        F.col("event_type").try_cast("bigint").alias("not_a_number"),
        F.abs(value - 100).alias("distance"),
        F.sqrt(F.greatest(value - 100, F.lit(0.0))).alias("root"),
        F.floor(value / 7).cast("bigint").alias("sevenths"),
        F.least(F.greatest(F.floor(value), F.lit(0)), F.lit(200)).cast("bigint").alias("clamped"),
        F.coalesce(F.when(value > 50, F.lit("much")), F.lit("little")).alias("amount"),
        (F.col("event_id") % 7).alias("modulo"),
    )


@query
def date_functions(spark, d):
    """Month texts, month bounds and padded dates."""
    month = F.date_format("o_orderdate", "yyyyMM")
    first, last = month_bounds(month)
    return warehouse.table(spark, d, "orders").select(
        "o_orderkey",
        month.alias("month"),
        first.alias("first_day"),
        last.alias("last_day"),
        F.format_string("%04d-%02d", F.year("o_orderdate"), F.month("o_orderdate")).alias("padded"),
    )
