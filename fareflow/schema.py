"""Schemas and fixed values shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# The input format, the quality limits and the lookup rows that results depend on.
TIME_PATTERN = "dd-MM-yyyy HH:mm"
LOCAL_ZONE = "Asia/Kolkata"
WATERMARK_DELAY = "10 minutes"
MAX_SPEED = 120
MAX_DURATION = 180
RULES = {"valid_speed": "speed <= 120", "valid_duration": "trip_duration <= 180"}
ZONES = [
    ("Bronx", "Zone-01"),
    ("Brooklyn", "Zone-02"),
    ("Manhattan", "Zone-03"),
    ("Queens", "Zone-04"),
    ("Staten Island", "Zone-05"),
]

KEY = "trip_id"
ARRIVAL = "ingestion_timestamp"
MALFORMED = "_corrupt_record"


def _struct(columns: str) -> T.StructType:
    """Nullable columns from "name type, …" text; unlike DDL parsing this needs no running session."""
    struct = T.StructType()
    for column in columns.split(", "):
        struct.add(*column.split(" "))
    return struct


# Trip files: every field is text on arrival.
RAW = _struct(
    "trip_id string, driver_id string, passenger_count string, pickup_datetime string, "
    "dropoff_datetime string, pickup_zone string, dropoff_zone string, trip_distance string, "
    "fare_amount string, tip_amount string, total_amount string"
)

BRONZE = T.StructType(RAW.fields + _struct("source_file string, ingestion_timestamp timestamp").fields)

# The same columns after the tolerant casts; trip times are still text.
SANITIZED = _struct(
    "trip_id string, driver_id string, passenger_count integer, pickup_datetime string, "
    "dropoff_datetime string, pickup_zone string, dropoff_zone string, trip_distance double, "
    "fare_amount double, tip_amount double, total_amount double, source_file string, "
    "ingestion_timestamp timestamp"
)

_TYPED = _struct(
    "trip_id string, driver_id string, passenger_count integer, pickup_datetime timestamp, "
    "dropoff_datetime timestamp, pickup_zone string, dropoff_zone string, trip_distance double, "
    "fare_amount double, tip_amount double, total_amount double, source_file string, "
    "ingestion_timestamp timestamp"
)

SILVER = T.StructType(
    _TYPED.fields
    + _struct(
        "trip_duration double, speed double, revenue_valid boolean, zone_name string, "
        "zone_id string, processing_timestamp timestamp"
    ).fields
)

_LOG_TAIL = (
    T.StructType(_struct("error_reason string, error_category string").fields)
    .add("row_data", SANITIZED)
    .add("error_timestamp", T.TimestampType())
)

ERROR_LOG = T.StructType(_TYPED.fields + _struct("trip_duration double, speed double").fields + _LOG_TAIL.fields)

DUPLICATE_LOG = T.StructType(SANITIZED.fields + _LOG_TAIL.fields)

ZONE_LOOKUP = _struct("zone_name string, zone_id string")

GOLD_ZONE_REVENUE = _struct(
    "pickup_zone string, dropoff_zone string, zone_id string, total_revenue double, trip_count long, "
    "avg_fare double, avg_duration double, avg_distance double, processing_timestamp timestamp"
)

GOLD_PEAK_HOURS = _struct("pickup_hour integer, trips long, processing_timestamp timestamp")

GOLD_DRIVER_PERF = _struct("driver_id string, avg_fare double, total_trips long, processing_timestamp timestamp")

# What each batch adds to the aggregates.
ZONE_SUMS = _struct(
    "pickup_zone string, dropoff_zone string, zone_id string, total_revenue double, trip_count long, "
    "fare_sum double, fare_n long, duration_sum double, duration_n long, distance_sum double, distance_n long"
)

HOUR_SUMS = _struct("pickup_hour integer, trips long")

DRIVER_SUMS = _struct("driver_id string, total_sum double, total_n long, total_trips long")

QUALITY_LOG = _struct(
    "row_count long, valid_speed_violations long, valid_duration_violations long, unparsed_times long, backwards_times long"
)

PIPELINE_LOG = _struct(
    "RunId string, Timestamp timestamp, Status string, ProcessedRecordCount long, "
    "InvalidAnomalyCount long, DuplicateCount long, FileName string"
)

RUN_LOG = _struct(
    "RunId string, PipelineId string, UpdateId string, Status string, StartTimeIST timestamp, "
    "EndTimeIST timestamp, ErrorMessage string"
)

SEEN_IDS = _struct("trip_id string, bucket integer")


# Closed windows of event time.
ZONE_HOURS = _struct("window_start timestamp, window_end timestamp, pickup_zone string, trips long, total_revenue double")

# Batches of running stages, and how each stage ended.
PROGRESS_LOG = _struct(
    "run_id string, stage string, batch long, started timestamp, millis long, input_rows long, state_rows long, "
    "late_groups long, watermark timestamp, status string, message string"
)

# Aggregates that are kept up to date by key, in parts by a hash of it, and the version of each part by batch.
DRIVER_TOTALS = T.StructType(GOLD_DRIVER_PERF.fields + _struct("part integer").fields)

ZONE_TOTALS = T.StructType(GOLD_ZONE_REVENUE.fields + _struct("part integer").fields)

KEYED_COMMITS = T.StructType(_struct("of string").fields).add("versions", T.MapType(T.IntegerType(), T.LongType()))

# Trips read by the header of their own file, with what fits no column.
RESCUED = (
    T.StructType([*RAW.fields])
    .add("rescued", T.MapType(T.StringType(), T.StringType()))
    .add(MALFORMED, T.StringType())
    .add("source_file", T.StringType())
    .add(ARRIVAL, T.TimestampType())
)
