"""The catalogue's queries once more, as SQL that another engine can run over the same tables."""

from __future__ import annotations

_ZONE = """CASE {key} % 6 WHEN 0 THEN 'Bronx' WHEN 1 THEN 'Brooklyn' WHEN 2 THEN 'Manhattan'
           WHEN 3 THEN 'Queens' WHEN 4 THEN 'Staten Island' ELSE 'EWR' END"""

_RAW = f"""raw AS (
    SELECT CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE 'T' || l_orderkey || '-' || l_linenumber END AS trip_id,
        'D' || l_suppkey AS driver_id,
        CASE WHEN l_partkey % 211 = 0 THEN 'x' ELSE CAST(1 + l_linenumber % 6 AS VARCHAR) END AS passenger_count,
        CASE WHEN l_partkey % 301 = 0 THEN 'bad-date'
             ELSE strftime(l_shipdate + to_minutes(l_partkey % 1440), '%d-%m-%Y %H:%M') END AS pickup_datetime,
        strftime(l_shipdate + to_minutes(
            l_partkey % 1440 + (l_partkey * 7 + l_suppkey * 13 + l_linenumber) % 200 - 5
        ), '%d-%m-%Y %H:%M') AS dropoff_datetime,
        {_ZONE.format(key="l_suppkey")} AS pickup_zone,
        {_ZONE.format(key="l_partkey")} AS dropoff_zone,
        CASE WHEN l_partkey % 89 = 0 THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS trip_distance,
        l_extendedprice AS fare_amount,
        l_discount * 100 AS tip_amount,
        CASE l_returnflag WHEN 'R' THEN l_extendedprice * 0.99::DOUBLE
             WHEN 'A' THEN l_extendedprice + l_discount * 100 END AS total_amount,
        l_shipdate + to_minutes(l_partkey % 1440) AS ingestion_timestamp
    FROM lineitem
)"""

_CLEAN = """clean AS (
    SELECT trip_id, driver_id, TRY_CAST(TRY_CAST(passenger_count AS DOUBLE) AS INTEGER) AS passenger_count,
        pickup_datetime, dropoff_datetime, pickup_zone, dropoff_zone,
        TRY_CAST(trip_distance AS DOUBLE) AS trip_distance, fare_amount, tip_amount, total_amount,
        ingestion_timestamp
    FROM raw
)"""

_TIMED = """timed AS (
    SELECT *,
        try_strptime(pickup_datetime, '%d-%m-%Y %H:%M') + INTERVAL 330 MINUTE AS picked_up,
        try_strptime(dropoff_datetime, '%d-%m-%Y %H:%M') + INTERVAL 330 MINUTE AS dropped_off
    FROM clean
)"""

_MEASURED = """measured AS (
    SELECT *, CASE WHEN trip_duration > 0 THEN trip_distance / (trip_duration / 60::DOUBLE) END AS speed
    FROM (SELECT *, date_diff('second', picked_up, dropped_off) / 60::DOUBLE AS trip_duration FROM timed)
)"""

_RANKED = """ranked AS (
    SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY
        ingestion_timestamp NULLS FIRST, driver_id NULLS FIRST, passenger_count NULLS FIRST,
        picked_up NULLS FIRST, dropped_off NULLS FIRST, pickup_zone NULLS FIRST, dropoff_zone NULLS FIRST,
        trip_distance NULLS FIRST, fare_amount NULLS FIRST, tip_amount NULLS FIRST, total_amount NULLS FIRST,
        pickup_datetime NULLS FIRST, dropoff_datetime NULLS FIRST) AS copy
    FROM measured WHERE trip_id IS NOT NULL
)"""

_ZONES = """zones(zone_name, zone_id) AS (
    VALUES ('Bronx', 'Zone-01'), ('Brooklyn', 'Zone-02'), ('Manhattan', 'Zone-03'), ('Queens', 'Zone-04'),
        ('Staten Island', 'Zone-05')
)"""

_SILVER_COLUMNS = """trip_id, driver_id, passenger_count, picked_up AS pickup_datetime,
        dropped_off AS dropoff_datetime, pickup_zone, dropoff_zone, trip_distance, fare_amount, tip_amount,
        coalesce(total_amount, fare_amount + tip_amount) AS total_amount, ingestion_timestamp, trip_duration,
        speed, coalesce(coalesce(total_amount, fare_amount + tip_amount) >= fare_amount, FALSE) AS revenue_valid,
        zone_name, zone_id"""

_SILVER = f"""silver AS (
    SELECT {_SILVER_COLUMNS}
    FROM ranked LEFT JOIN zones ON pickup_zone = zone_name
    WHERE copy = 1 AND coalesce(speed <= 120, TRUE) AND coalesce(trip_duration <= 180, TRUE)
)"""

_SNAPSHOT = ", ".join(
    f"{name} AS row_{name}"
    for name in (
        "trip_id driver_id passenger_count pickup_datetime dropoff_datetime pickup_zone dropoff_zone "
        "trip_distance fare_amount tip_amount total_amount ingestion_timestamp"
    ).split()
)

_ERRORS = f"""errors AS (
    SELECT trip_id, driver_id, passenger_count, picked_up AS pickup_datetime, dropped_off AS dropoff_datetime,
        pickup_zone, dropoff_zone, trip_distance, fare_amount, tip_amount, total_amount, ingestion_timestamp,
        trip_duration, speed, CASE WHEN speed > 120 THEN 'Invalid Speed' ELSE 'Invalid Duration' END AS error_reason,
        'INVALID' AS error_category, {_SNAPSHOT}
    FROM measured WHERE speed > 120 OR trip_duration > 180
    UNION ALL
    SELECT trip_id, driver_id, passenger_count, picked_up, dropped_off, pickup_zone, dropoff_zone,
        trip_distance, fare_amount, tip_amount, total_amount, ingestion_timestamp, NULL, NULL,
        'Missing trip_id', 'ANOMALY', {_SNAPSHOT}
    FROM measured WHERE trip_id IS NULL
)"""

_STEPS = {
    "raw": (_RAW, None),
    "clean": (_CLEAN, "raw"),
    "timed": (_TIMED, "clean"),
    "measured": (_MEASURED, "timed"),
    "ranked": (f"{_ZONES}, {_RANKED}", "measured"),
    "silver": (_SILVER, "ranked"),
}


def _with(step: str, *more: str) -> str:
    chain: list[str] = []
    while step:
        text, step = _STEPS[step]
        chain.insert(0, text)
    return "WITH " + ", ".join([*chain, *more]) + "\n"


_BRONZE_INGEST = _with("raw") + "SELECT * EXCLUDE (ingestion_timestamp), TRUE AS from_csv FROM raw"
_ERROR_LOG = _with("measured", _ERRORS) + "SELECT * FROM errors"
_SILVER_TRIPS = _with("silver") + "SELECT * FROM silver"

_ZONE_REVENUE = _with("silver") + """
SELECT pickup_zone, dropoff_zone, zone_id, round(sum(total_amount), 4) AS total_revenue, count(trip_id) AS trip_count,
    round(avg(fare_amount), 2) AS avg_fare, avg(trip_duration) AS avg_duration,
    avg(trip_distance) AS avg_distance
FROM silver GROUP BY pickup_zone, dropoff_zone, zone_id"""

_PEAK_HOURS = _with("silver") + """
SELECT CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, count(trip_id) AS trips
FROM silver GROUP BY hour(pickup_datetime)"""

_DRIVER_PERF = _with("silver") + """
SELECT driver_id, round(avg(total_amount), 2) AS avg_fare, count(trip_id) AS total_trips
FROM silver GROUP BY driver_id"""

_LAYER_COUNTS = _with("silver", _ERRORS) + """
SELECT 'SUCCESS' AS "Status", (SELECT count(*) FROM silver) AS "ProcessedRecordCount",
    (SELECT count(*) FROM errors) AS "InvalidAnomalyCount",
    (SELECT count(*) FROM ranked WHERE copy > 1) AS "DuplicateCount", 'N/A' AS "FileName\""""

_DISTINCT_IDS = _with("raw") + "SELECT DISTINCT trip_id FROM raw WHERE trip_id IS NOT NULL"

_EXPECT = _with("measured") + """
SELECT trip_id, trip_duration, speed FROM measured
WHERE coalesce(speed <= 120, {unknown}) AND coalesce(trip_duration <= 180, {unknown})"""

_DUPLICATE_LOG = (_with("ranked")
    + f"""SELECT trip_id, driver_id, passenger_count, pickup_datetime, dropoff_datetime, pickup_zone, dropoff_zone,
    trip_distance, fare_amount, tip_amount, total_amount, ingestion_timestamp,
    'Duplicate trip_id' AS error_reason, 'DUPLICATE' AS error_category, {_SNAPSHOT}
FROM ranked WHERE copy > 1""")

# Three runs: some early trips come in the last one. A row is late if its window ended before the mark of the run before.
_RUN = """CASE WHEN l_shipdate < TIMESTAMP '1995-06-01' AND l_partkey % 50 <> 0 THEN 1
    WHEN l_shipdate >= TIMESTAMP '1995-06-01' AND l_shipdate < TIMESTAMP '1997-01-01' THEN 2 ELSE 3 END AS run"""
_ZONE_HOURS = (
    _with("ranked")
    .replace("FROM lineitem", f", {_RUN} FROM lineitem")
    .replace("ingestion_timestamp\n    FROM raw", "ingestion_timestamp, run\n    FROM raw")
    .replace("ORDER BY\n        ingestion_timestamp", "ORDER BY run, ingestion_timestamp")
    + """, kept AS (
    SELECT run, pickup_zone, picked_up, trip_id, coalesce(total_amount, fare_amount + tip_amount) AS total_amount,
        date_trunc('hour', picked_up)::TIMESTAMP AS window_start,
        date_trunc('hour', picked_up)::TIMESTAMP + INTERVAL 1 HOUR AS window_end
    FROM ranked WHERE copy = 1 AND coalesce(speed <= 120, TRUE) AND coalesce(trip_duration <= 180, TRUE)
), marks AS (
    SELECT r.run, max(picked_up) - INTERVAL 10 MINUTE AS mark
    FROM (VALUES (1), (2), (3)) AS r(run) JOIN kept ON kept.run <= r.run GROUP BY r.run
), judged AS (
    SELECT kept.*, coalesce(window_end <= before.mark, FALSE) AS is_late
    FROM kept LEFT JOIN marks AS before ON before.run = kept.run - 1
    WHERE picked_up IS NOT NULL AND window_end <= (SELECT max(mark) FROM marks)
)
SELECT window_start, window_end, pickup_zone, count(trip_id) FILTER (NOT is_late) AS trips,
    round(sum(total_amount) FILTER (NOT is_late), 4) AS total_revenue, count(trip_id) FILTER (is_late) AS late
FROM judged GROUP BY window_start, window_end, pickup_zone"""
)

# Files of three kinds by the last digit of the driver; broken lines have four fields or one too many.
_KINDS = _with("raw", """kinds AS (
    SELECT *, CAST(right(driver_id, 1) AS INTEGER) % 3 AS kind,
        CAST(right(driver_id, 1) AS INTEGER) % 3 = 2 AND pickup_zone = 'Bronx' AS cut FROM raw
)""")
_AFTER_CUT = ", ".join(
    f"CASE WHEN NOT cut THEN {name} END AS {name}"
    for name in "dropoff_datetime pickup_zone dropoff_zone trip_distance fare_amount tip_amount total_amount".split()
)
_BRONZE_RESCUED = (
    _KINDS
    + f"""SELECT trip_id, driver_id, passenger_count, pickup_datetime, {_AFTER_CUT},
    CASE WHEN kind = 1 THEN 'V, ' || driver_id END AS vendor, CAST(kind = 1 AS INTEGER) AS n_rescued, kind = 2 AS malformed
FROM kinds"""
)
_BRONZE_LEDGER = (
    _KINDS
    + """SELECT CASE kind WHEN 2 THEN 'broken' WHEN 1 THEN 'other columns' ELSE 'usual' END AS kind, count(*) AS rows_read,
    count(*) FILTER (kind = 2) AS malformed, count(*) FILTER (kind = 1) AS with_rescued
FROM kinds GROUP BY ALL"""
)

_DEDUP_FIRST = (
    _with("ranked")
    + """SELECT trip_id, driver_id, passenger_count, picked_up AS pickup_datetime, dropped_off AS dropoff_datetime,
    pickup_zone, dropoff_zone, trip_distance, fare_amount, tip_amount, total_amount, ingestion_timestamp
FROM ranked WHERE copy = 1"""
)

ORACLES: dict[str, str] = {
    "bronze_ingest": _BRONZE_INGEST,
    "sanitize_numeric": _with("clean") + "SELECT * FROM clean",
    "trip_times": _with("timed")
    + "SELECT trip_id, picked_up AS pickup_datetime, dropped_off AS dropoff_datetime FROM timed",
    "trip_metrics": _with("measured")
    + """SELECT trip_id, trip_duration, speed, coalesce(total_amount, fare_amount + tip_amount) AS total_amount,
    coalesce(coalesce(total_amount, fare_amount + tip_amount) >= fare_amount, FALSE) AS revenue_valid
FROM measured""",
    "expect_drop": _EXPECT.format(unknown="TRUE"),
    "expect_drop_null": _EXPECT.format(unknown="FALSE"),
    "expect_warn": _with("ranked")
    + """SELECT count(*) AS row_count, count(*) FILTER (speed > 120) AS valid_speed_violations,
    count(*) FILTER (trip_duration > 180) AS valid_duration_violations
FROM ranked WHERE copy = 1""",
    "dedup_first": _DEDUP_FIRST,
    "dedup_first_stored": _DEDUP_FIRST,
    "duplicate_log_stored": _DUPLICATE_LOG,
    "enrich_zone": _with("raw", _ZONES)
    + """SELECT trip_id, pickup_zone, zone_name, zone_id
FROM raw LEFT JOIN zones ON pickup_zone = zone_name""",
    "silver_trips": _SILVER_TRIPS,
    "silver_trips_strict": _SILVER_TRIPS + " WHERE speed <= 120 AND trip_duration <= 180",
    "error_log": _ERROR_LOG,
    "duplicate_log": _DUPLICATE_LOG,
    "gold_zone_revenue": _ZONE_REVENUE,
    "gold_peak_hours": _PEAK_HOURS,
    "gold_driver_perf": _DRIVER_PERF,
    "peak_hours_text": _with("silver")
    + """SELECT strftime(pickup_datetime, '%H') AS pickup_hour, count(trip_id) AS trips
FROM silver GROUP BY strftime(pickup_datetime, '%H')""",
    "pipeline_log": _LAYER_COUNTS,
    "layer_counts": _LAYER_COUNTS,
    "run_log": _with("silver")
    + """SELECT 'trips' AS "PipelineId", 'update-1' AS "UpdateId", 'SUCCESS' AS "Status",
    CAST(NULL AS VARCHAR) AS "ErrorMessage", TRUE AS ends_after_start, count(*) AS "ProcessedRecordCount"
FROM silver""",
    "stream_bronze": _with("raw") + "SELECT * FROM raw",
    "stream_silver": _SILVER_TRIPS,
    "stream_error_log": _ERROR_LOG,
    "stream_gold_zone_revenue": _ZONE_REVENUE,
    "stream_gold_peak_hours": _PEAK_HOURS,
    "stream_gold_driver_perf": _DRIVER_PERF,
    "stream_gold_complete": _PEAK_HOURS,
    "stream_zone_hours": _ZONE_HOURS,
    "stream_gold_driver_update": _DRIVER_PERF,
    "stream_gold_zone_update": _ZONE_REVENUE,
    "bronze_rescued": _BRONZE_RESCUED,
    "bronze_ledger": _BRONZE_LEDGER,
    "progress_rows": """SELECT stage, input_rows, 0::BIGINT AS state_rows, 'COMPLETED' AS ended
FROM (VALUES ('bronze_trips'), ('error_log')) AS stages(stage), (SELECT count(*) AS input_rows FROM lineitem)""",
    "stream_duplicate_log": _DUPLICATE_LOG,
    "quality_counts": _with("ranked")
    + """SELECT count(*) AS row_count, count(*) FILTER (speed > 120) AS valid_speed_violations,
    count(*) FILTER (trip_duration > 180) AS valid_duration_violations,
    count(*) FILTER (trip_duration IS NULL) AS unparsed_times,
    count(*) FILTER (trip_duration <= 0) AS backwards_times, 'RULES' AS error_category
FROM ranked WHERE copy = 1""",
    "category_counts": _with("measured", _ERRORS)
    + 'SELECT error_category, count(*) AS "rows" FROM errors GROUP BY error_category',
    "error_log_strict": _with("measured")
    + """SELECT error_category, error_reason, count(*) AS "rows" FROM (
    SELECT 'INVALID' AS error_category, CASE WHEN speed > 120 THEN 'Invalid Speed'
        WHEN trip_duration > 180 THEN 'Invalid Duration' ELSE 'Unknown Speed or Duration' END AS error_reason
    FROM measured WHERE NOT coalesce(speed <= 120 AND trip_duration <= 180, FALSE)
    UNION ALL SELECT 'ANOMALY', 'Missing trip_id' FROM measured WHERE trip_id IS NULL)
GROUP BY error_category, error_reason""",
    "stream_dedup_bounded": _DISTINCT_IDS,
    "stream_dedup_unbounded": _DISTINCT_IDS,
}
