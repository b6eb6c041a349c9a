"""Table layouts. Column order is part of each table's contract."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------------------
LOCAL_ZONE = "America/New_York"
OTHER_BOROUGH = "Other"
UNKNOWN_BOROUGH = "Unknown"

RIDE_DECISIONS = (
    "dropped_short_row",
    "dropped_no_station",
    "dropped_bad_timestamp",
    "dropped_too_short",
    "dropped_too_long",
    "kept",
)
EVENT_DECISIONS = ("dropped_short_row", "dropped_empty", "dropped_bad_timestamp", "kept")
WEATHER_DATATYPES = ("TMAX", "TMIN", "PRCP", "SNOW")
DEMAND_QUANTILES = {"q20": 0.20, "q40": 0.40, "q60": 0.60, "q80": 0.80}
EVENT_QUANTILES = {"p33": 0.33, "p66": 0.66}
MIN_RIDE_MINUTES = 1
MAX_RIDE_MINUTES = 1440
RIDES_SOURCE, WEATHER_SOURCE, EVENTS_SOURCE, STATIONS_SOURCE = "citibike", "noaa", "events", "station_to_borough"
LEDGER_SOURCES = (RIDES_SOURCE, WEATHER_SOURCE, EVENTS_SOURCE, STATIONS_SOURCE)
FILE_PATTERNS = {
    "citibike": "%s-citibike-tripdata.zip",
    "noaa": "noaa_USW00094728_%s.json",
    "events": "events_%s.csv",
}
FIRST_MONTH = "202503"
LAST_MONTH = "202511"
# ----------------------------------------------------------------------------------------------

CORRUPT = "_corrupt_record"

# Minutes with two decimals never exceed 1440.00, so eight digits leave Spark summing plain longs.
MINUTES = T.DecimalType(8, 2)
MEASURE = T.DecimalType(18, 2)
COEFFICIENT = T.DecimalType(18, 4)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()

RIDES_RAW = _struct(
    ("ride_id", _S),
    ("rideable_type", _S),
    ("started_at", _S),
    ("ended_at", _S),
    ("start_station_name", _S),
    ("start_station_id", _S),
    ("end_station_name", _S),
    ("end_station_id", _S),
    ("start_lat", _S),
    ("start_lng", _S),
    ("end_lat", _S),
    ("end_lng", _S),
    ("member_casual", _S),
)

STATIONS = _struct(
    ("start_station_id", _S),
    ("station_name", _S),
    ("latitude", _D),
    ("longitude", _D),
    ("borough", _S),
)

# Positions 2, 5 and 6 are used; the names of the others only document the public permit file.
EVENTS_RAW = _struct(
    ("event_id", _S),
    ("event_name", _S),
    ("start_date_time", _S),
    ("end_date_time", _S),
    ("event_agency", _S),
    ("event_type", _S),
    ("event_borough", _S),
)

WEATHER_DOCUMENT = _struct(
    ("station", _S),
    ("month", _S),
    ("start_date", _S),
    ("end_date", _S),
    ("datatypes", T.ArrayType(_S)),
    ("fetched_at", _S),
    ("record_count", _L),
    ("results", T.ArrayType(_struct(("date", _S), ("datatype", _S), ("value", _D)))),
)

_FEATURE = _struct(
    ("properties", T.MapType(_S, _S)),
    ("geometry", _struct(("type", _S), ("coordinates", _S))),
)
POLYGON_DOCUMENT = _struct(("features", T.ArrayType(_FEATURE)))
POLYGON_FEATURE = _FEATURE

STAGE_TABLES = {
    "T1": _struct(
        ("ride_id", _S),
        ("date", T.DateType()),
        ("borough", _S),
        ("rideable_type", _S),
        ("member_casual", _S),
        ("ride_duration_min", MINUTES),
        ("start_station_id", _S),
    ),
    "T2_rides": _struct(
        ("date", T.DateType()),
        ("borough", _S),
        ("total_rides", _L),
        ("member_rides", _L),
        ("avg_duration_min", MINUTES),
    ),
    "T2_events": _struct(
        ("date", T.DateType()),
        ("borough", _S),
        ("event_count", _L),
        ("event_types", _S),
    ),
    "T2": _struct(
        ("date", T.DateType()),
        ("borough", _S),
        ("total_rides", _L),
        ("member_rides", _L),
        ("avg_duration_min", MINUTES),
        ("temp", MEASURE),
        ("precip", MEASURE),
        ("snow", MEASURE),
        ("event_count", _L),
        ("event_types", _S),
    ),
    "T3a": _struct(
        ("borough", _S),
        ("mean", MEASURE),
        ("stddev", MEASURE),
        ("q20", MEASURE),
        ("q40", MEASURE),
        ("q60", MEASURE),
        ("q80", MEASURE),
    ),
    "T3b": _struct(
        ("borough", _S),
        ("beta0", COEFFICIENT),
        ("beta1_temp", COEFFICIENT),
        ("beta2_precip", COEFFICIENT),
        ("beta3_snow", COEFFICIENT),
        ("rmse", MEASURE),
    ),
    "T3c": _struct(("borough", _S), ("p33", _L), ("p66", _L)),
    "W": _struct(
        ("date", T.DateType()),
        ("borough", _S),
        ("total_rides", _L),
        ("member_rides", _L),
        ("avg_duration_min", MINUTES),
        ("temp", MEASURE),
        ("precip", MEASURE),
        ("snow", MEASURE),
        ("event_types", _S),
        ("expected_rides", _L),
        ("event_intensity", _S),
        ("anomaly", T.BooleanType()),
        ("demand_level", _S),
    ),
}

LEDGER = _struct(
    ("source", _S),
    ("filename", _S),
    ("run_date", _S),
    ("path", _S),
    ("size_bytes", _L),
    ("sha256", _S),
    ("record_count", _L),
    ("dataset_id", _S),
    ("downloaded_at", _S),
)

# The ledger as one nested document, as older landing runs wrote it.
_ENTRY = T.StructType(
    [T.StructField("hdfs_path" if f.name == "path" else f.name, f.dataType) for f in LEDGER.fields[2:]]
)
MANIFEST = _struct(
    ("version", _L), ("last_updated", _S), ("sources", T.MapType(_S, T.MapType(_S, _ENTRY)))
)
