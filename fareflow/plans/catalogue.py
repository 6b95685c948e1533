"""Every operator as a query over the ``lineitem`` table, for checks and timing.

Clock columns are left out, timestamps are returned without a zone and floating-point aggregates
are rounded, so that results compare with other engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import revenue_fields, sanitize_numeric, trip_metrics, trip_times
from ..operators import count_violations, enrich_zone, expect_or_drop, first_copies, stream_first_copies
from ..schema import MALFORMED, RAW, SANITIZED
from ..session import shared_folder, use_utc
from ..sources.layers import COMPRESSION
from ..sources import Layers, csv_schema, file_ledger, raw_trips, stream_table, stream_trips
from ..streaming import (
    bronze_stage,
    error_stage,
    finish,
    follow,
    gold_stage,
    gold_totals,
    keyed_stage,
    late_trips,
    read_keyed,
    rescued_stage,
    run_layers,
    silver_stage,
    window_stage,
)
from . import errors, gold
from .clustered import store_by_id, stored_duplicates, stored_firsts
from .logs import append_layer_counts, pipeline_log, tracked_run
from .silver import derive, prepare, silver_trips

Query = Callable[[SparkSession, str], DataFrame]

# Trips that arrive before this day come in the first run of a stream.
_CUT = "1995-06-01"
_LATER_CUT = "1997-01-01"

_COUNTS = ("Status", "ProcessedRecordCount", "InvalidAnomalyCount", "DuplicateCount", "FileName")


def _lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{folder}/lineitem.parquet")


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return raw_trips(_lineitem(spark, folder))


def _raw_stream(spark: SparkSession, folder: str) -> DataFrame:
    return raw_trips(stream_table(spark, folder, "lineitem", _lineitem(spark, folder).schema))


def _layers(spark: SparkSession) -> Layers:
    root = shared_folder(use_utc(spark))
    return Layers(spark, root, prefix=root.rsplit("/", 1)[-1].replace("-", "_"))


def _comparable(rows: DataFrame, *leave_out: str) -> DataFrame:
    rows = rows.drop("source_file", "processing_timestamp", "error_timestamp", *leave_out)
    zoned = [f.name for f in rows.schema.fields if f.dataType.typeName() == "timestamp"]
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def _rounded(rows: DataFrame) -> DataFrame:
    # Sums of money depend on the order of addition; distances and durations are whole here.
    digits = {"total_revenue": 4, "avg_fare": 2}
    rows = rows.drop("processing_timestamp")
    return rows.withColumns({name: F.round(name, n) for name, n in digits.items() if name in rows.columns})


def _unpacked(log: DataFrame) -> DataFrame:
    """Log rows with their snapshot as columns of its own."""
    names = [name for name in SANITIZED.names if name != "source_file"]
    fields = {f"row_{name}": F.col(f"row_data.{name}") for name in names}
    return _comparable(log.withColumns(fields), "row_data")


def bronze_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Raw trips written as CSV files with a header, and taken in by a stream over that folder."""
    layers = _layers(spark)
    landing = f"{layers.root}/landing"
    _raw(spark, folder).select(*RAW.names).write.option("header", True).csv(landing)
    finish(bronze_stage(layers, stream_trips(spark, landing, csv_schema(spark, landing))))
    stored = layers.read("bronze_trips")
    money = {name: F.col(name).try_cast("double") for name in ("fare_amount", "tip_amount", "total_amount")}
    stored = stored.withColumns(money | {"from_csv": F.col("source_file").endswith(".csv")})
    return stored.drop("source_file", "ingestion_timestamp")


def sanitize_numeric_query(spark: SparkSession, folder: str) -> DataFrame:
    return _comparable(sanitize_numeric(_raw(spark, folder)))


def trip_times_query(spark: SparkSession, folder: str) -> DataFrame:
    return _comparable(trip_times(_raw(spark, folder)).select("trip_id", "pickup_datetime", "dropoff_datetime"))


def trip_metrics_query(spark: SparkSession, folder: str) -> DataFrame:
    trips = trip_times(sanitize_numeric(_raw(spark, folder)))
    return revenue_fields(trip_metrics(trips)).select(
        "trip_id", "trip_duration", "speed", "total_amount", "revenue_valid"
    )


def _measured(spark: SparkSession, folder: str) -> DataFrame:
    return trip_metrics(trip_times(sanitize_numeric(_raw(spark, folder)))).select("trip_id", "trip_duration", "speed")


def expect_drop(spark: SparkSession, folder: str) -> DataFrame:
    return expect_or_drop(_measured(spark, folder))


def expect_drop_null(spark: SparkSession, folder: str) -> DataFrame:
    return expect_or_drop(_measured(spark, folder), on_null="drop")


def expect_warn(spark: SparkSession, folder: str) -> DataFrame:
    return count_violations(derive(first_copies(prepare(_raw(spark, folder)))))


def dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    return _comparable(first_copies(prepare(_raw(spark, folder))))


def _by_id(spark: SparkSession, folder: str) -> Layers:
    layers = _layers(spark)
    store_by_id(layers, _raw(spark, folder), hot_rows=100_000)
    return layers


def dedup_first_stored(spark: SparkSession, folder: str) -> DataFrame:
    """First copies over a raw layer that is stored by trip id."""
    return _comparable(stored_firsts(_by_id(spark, folder)))


def duplicate_log_stored(spark: SparkSession, folder: str) -> DataFrame:
    return _unpacked(stored_duplicates(_by_id(spark, folder)))


def enrich_zone_query(spark: SparkSession, folder: str) -> DataFrame:
    return enrich_zone(_raw(spark, folder)).select("trip_id", "pickup_zone", "zone_name", "zone_id")


def silver_trips_query(spark: SparkSession, folder: str) -> DataFrame:
    return _comparable(silver_trips(_raw(spark, folder)))


def silver_trips_strict(spark: SparkSession, folder: str) -> DataFrame:
    return _comparable(silver_trips(_raw(spark, folder), on_null="drop"))


def error_log(spark: SparkSession, folder: str) -> DataFrame:
    return _unpacked(errors.error_log(_raw(spark, folder)))


def duplicate_log(spark: SparkSession, folder: str) -> DataFrame:
    return _unpacked(errors.duplicate_log(_raw(spark, folder)))


def gold_zone_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(gold.zone_revenue(silver_trips(_raw(spark, folder))))


def gold_peak_hours(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(gold.peak_hours(silver_trips(_raw(spark, folder))))


def peak_hours_text(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(gold.peak_hours_text(silver_trips(_raw(spark, folder))))


def gold_driver_perf(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(gold.driver_performance(silver_trips(_raw(spark, folder))))


def pipeline_log_query(spark: SparkSession, folder: str) -> DataFrame:
    raw = _raw(spark, folder)
    return pipeline_log(silver_trips(raw), errors.error_log(raw), errors.duplicate_log(raw)).select(*_COUNTS)


def layer_counts(spark: SparkSession, folder: str) -> DataFrame:
    layers = _layers(spark)
    run_layers(layers, _raw_stream(spark, folder))
    append_layer_counts(layers)
    return layers.read("layer_counts").select(*_COUNTS)


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """A run over all layers and its log row, beside the row count that the run arrived at."""
    layers = _layers(spark)
    tracked_run(layers, "trips", "update-1", lambda: run_layers(layers, _raw_stream(spark, folder)))
    counts = layers.read("pipeline_log").select("Status", "ProcessedRecordCount")
    runs = layers.read("run_log").withColumn("ends_after_start", F.col("EndTimeIST") >= F.col("StartTimeIST"))
    return runs.join(counts, "Status").select(
        "PipelineId", "UpdateId", "Status", "ErrorMessage", "ends_after_start", "ProcessedRecordCount"
    )


def _in_runs(spark: SparkSession, folder: str, runs: list[Column], *after: Callable[[Layers], None]) -> Layers:
    """The raw and the cleaned layer, filled by streams in several runs of the rows that each condition picks.

    What comes ``after`` is called after each run.
    """
    layers = _layers(spark)
    rows = _lineitem(spark, folder)
    landing = f"{layers.root}/landing"
    for part in runs:
        rows.filter(part).write.mode("append").option("compression", COMPRESSION).parquet(f"{landing}/lineitem.parquet")
        finish(bronze_stage(layers, raw_trips(stream_table(spark, landing, "lineitem", rows.schema))))
        finish(silver_stage(layers))
        for step in after:
            step(layers)
    return layers


def _before(day: str) -> Column:
    return F.coalesce(F.col("l_shipdate") < F.lit(day).cast("timestamp_ntz"), F.lit(False))


def _streamed(spark: SparkSession, folder: str, *after: Callable[[Layers], None]) -> Layers:
    """Two runs: earlier arrivals, then all later ones. Equal arrival times stay in one run."""
    return _in_runs(spark, folder, [_before(_CUT), ~_before(_CUT)], *after)


def stream_bronze(spark: SparkSession, folder: str) -> DataFrame:
    layers = _layers(spark)
    finish(bronze_stage(layers, _raw_stream(spark, folder)))
    return _comparable(layers.read("bronze_trips"))


def stream_silver(spark: SparkSession, folder: str) -> DataFrame:
    return _comparable(_streamed(spark, folder).read("silver_trips"))


def stream_error_log(spark: SparkSession, folder: str) -> DataFrame:
    layers = _layers(spark)
    finish(bronze_stage(layers, _raw_stream(spark, folder)))
    finish(error_stage(layers))
    return _unpacked(layers.read("error_log"))


def _stream_gold(table: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        layers = _streamed(spark, folder)
        gold_totals(layers, table)
        return _rounded(layers.read(table))

    return query


def stream_zone_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Closed windows of event time and the trips that came too late for them, over three runs.

    The third run brings, besides the last trips, some that belong to the time of the first one.
    """
    held_back = _before(_CUT) & (F.col("l_partkey") % 50 == 0)
    runs = [_before(_CUT) & ~held_back, _before(_LATER_CUT) & ~_before(_CUT), ~_before(_LATER_CUT) | held_back]
    layers = _in_runs(spark, folder, runs, lambda layers: follow(layers, zone_hours=window_stage(layers)))
    key = ["window_start", "window_end", "pickup_zone"]
    # Zones may be missing, so both kinds of row are stacked rather than joined.
    counted = layers.read("zone_hours").select(*key, "trips", "total_revenue", F.lit(0).cast("long").alias("late"))
    late = late_trips(layers).select(*key, F.lit(0).cast("long").alias("trips"), F.lit(None).cast("double").alias("total_revenue"), "late")
    sums = [F.sum(name).alias(name) for name in ("trips", "total_revenue", "late")]
    return _comparable(_rounded(counted.union(late).groupBy(*key).agg(*sums)))


def _stream_keyed(table: str) -> Query:
    """An aggregate that is kept up to date by key, over three runs."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        runs = [_before(_CUT), _before(_LATER_CUT) & ~_before(_CUT), ~_before(_LATER_CUT)]
        layers = _in_runs(spark, folder, runs, lambda layers: finish(keyed_stage(layers, table)))
        return _rounded(read_keyed(layers, table))

    return query


def _mixed_landing(spark: SparkSession, folder: str, landing: str) -> None:
    """Raw trips as CSV files of three kinds: usual ones, ones with other columns in another order, and broken lines."""
    rows = raw_trips(_lineitem(spark, folder)).select(*RAW.names).withColumn("kind", F.right("driver_id", F.lit(1)).cast("int") % 3)
    rows.filter("kind = 0").select(*RAW.names).write.option("header", True).csv(landing)
    turned = rows.filter("kind = 1").withColumn("vendor", F.concat(F.lit("V, "), "driver_id"))
    turned.select("vendor", *reversed(RAW.names)).write.mode("append").option("header", True).csv(landing)
    broken = rows.filter("kind = 2")
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in RAW.names]
    cut = F.coalesce(F.col("pickup_zone") == "Bronx", F.lit(False))
    line = F.when(cut, F.concat_ws(",", *fields[:4])).otherwise(F.concat_ws(",", *fields, F.lit("surplus")))
    # Each file begins with the header: it goes before the first line of its part, and each part is one file.
    begins = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    lines = broken.select(line.alias("line")).withColumn("begins", begins)
    header = F.lit(",".join(RAW.names) + "\n")
    lines = lines.select(F.when(F.col("begins"), F.concat(header, "line")).otherwise(F.col("line")).alias("value"))
    lines.write.mode("append").option("maxRecordsPerFile", 0).text(landing)


def _rescued(spark: SparkSession, folder: str) -> DataFrame:
    layers = _layers(spark)
    _mixed_landing(spark, folder, f"{layers.root}/landing")
    finish(rescued_stage(layers, f"{layers.root}/landing"))
    return layers.read("bronze_rescued")


def bronze_rescued(spark: SparkSession, folder: str) -> DataFrame:
    rows = _rescued(spark, folder)
    money = {name: F.col(name).try_cast("double") for name in ("fare_amount", "tip_amount", "total_amount")}
    others = {"vendor": F.col("rescued")["vendor"], "n_rescued": F.size("rescued")}
    return rows.withColumns(money | others | {"malformed": F.col(MALFORMED).isNotNull()}).drop(
        "rescued", MALFORMED, "source_file", "ingestion_timestamp"
    )


def bronze_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, misfits and rescued values per source file, added up over files of the same kind."""
    ledger = file_ledger(_rescued(spark, folder))
    kind = F.when(F.col("malformed") > 0, "broken").when(F.col("with_rescued") > 0, "other columns").otherwise("usual")
    sums = [F.sum(name).alias(name) for name in ("rows_read", "malformed", "with_rescued")]
    return ledger.groupBy(kind.alias("kind")).agg(*sums)


def progress_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What stages that append report about themselves: rows taken in, and how they ended."""
    layers = _layers(spark)
    follow(layers, bronze_trips=bronze_stage(layers, _raw_stream(spark, folder)))
    follow(layers, error_log=error_stage(layers))
    log = layers.read("progress_log")
    ends = F.max(F.when(F.col("status") != "BATCH", F.col("status"))).alias("ended")
    return log.groupBy("stage").agg(F.sum("input_rows").alias("input_rows"), F.max("state_rows").alias("state_rows"), ends)


def stream_gold_complete(spark: SparkSession, folder: str) -> DataFrame:
    """Trips per hour kept in the state store, over two micro-batches: one after each run."""
    layers = _streamed(spark, folder, lambda layers: finish(gold_stage(layers, "gold_peak_hours")))
    return _rounded(layers.read("gold_peak_hours"))


def stream_duplicate_log(spark: SparkSession, folder: str) -> DataFrame:
    return _unpacked(_streamed(spark, folder).read("duplicate_log"))


def quality_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What the rules counted, added up over the batches, next to the rows that came out."""
    layers = _streamed(spark, folder)
    log = layers.read("quality_log")
    totals = log.agg(*[F.sum(name).alias(name) for name in log.columns])
    return totals.withColumn("error_category", F.lit("RULES"))


def category_counts(spark: SparkSession, folder: str) -> DataFrame:
    return errors.category_counts(errors.error_log(_raw(spark, folder)))


def error_log_strict(spark: SparkSession, folder: str) -> DataFrame:
    """With unknown answers dropped from the cleaned layer, the log has them too."""
    return errors.error_log(_raw(spark, folder), on_null="drop").groupBy("error_category", "error_reason").agg(
        F.count(F.lit(1)).alias("rows")
    )


def _stream_dedup(policy: str) -> Query:
    """Ids that a state-store policy lets through when all rows arrive in one batch."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        layers = _layers(spark)
        finish(bronze_stage(layers, stream_first_copies(_raw_stream(spark, folder), policy=policy)))
        return layers.read("bronze_trips").select("trip_id")

    return query


QUERIES: dict[str, Query] = {
    "bronze_ingest": bronze_ingest,
    "sanitize_numeric": sanitize_numeric_query,
    "trip_times": trip_times_query,
    "trip_metrics": trip_metrics_query,
    "expect_drop": expect_drop,
    "expect_drop_null": expect_drop_null,
    "expect_warn": expect_warn,
    "dedup_first": dedup_first,
    "dedup_first_stored": dedup_first_stored,
    "duplicate_log_stored": duplicate_log_stored,
    "enrich_zone": enrich_zone_query,
    "silver_trips": silver_trips_query,
    "silver_trips_strict": silver_trips_strict,
    "error_log": error_log,
    "duplicate_log": duplicate_log,
    "gold_zone_revenue": gold_zone_revenue,
    "gold_peak_hours": gold_peak_hours,
    "gold_driver_perf": gold_driver_perf,
    "peak_hours_text": peak_hours_text,
    "pipeline_log": pipeline_log_query,
    "layer_counts": layer_counts,
    "run_log": run_log,
    "stream_bronze": stream_bronze,
    "stream_silver": stream_silver,
    "stream_error_log": stream_error_log,
    "stream_gold_zone_revenue": _stream_gold("gold_zone_revenue"),
    "stream_gold_peak_hours": _stream_gold("gold_peak_hours"),
    "stream_gold_driver_perf": _stream_gold("gold_driver_perf"),
    "stream_gold_complete": stream_gold_complete,
    "stream_zone_hours": stream_zone_hours,
    "stream_gold_driver_update": _stream_keyed("driver_totals"),
    "stream_gold_zone_update": _stream_keyed("zone_totals"),
    "bronze_rescued": bronze_rescued,
    "bronze_ledger": bronze_ledger,
    "progress_rows": progress_rows,
    "stream_duplicate_log": stream_duplicate_log,
    "quality_counts": quality_counts,
    "category_counts": category_counts,
    "error_log_strict": error_log_strict,
    "stream_dedup_bounded": _stream_dedup("bounded"),
    "stream_dedup_unbounded": _stream_dedup("unbounded"),
}
