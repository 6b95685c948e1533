"""Streams give what batches give, for one file or many, and after crashes and restarts."""

import os

import pytest
from golden import TRIPS, frame, write_csv
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from fareflow.operators import stream_first_copies
from fareflow.plans import errors, gold
from fareflow.plans.silver import silver_trips
from fareflow.schema import BRONZE, MALFORMED, RAW
from fareflow.sources import csv_schema, read_trips, stream_trips
from fareflow.streaming import bronze_stage, error_stage, exact, finish, gold_stage, gold_totals, run_layers, silver_stage

CLOCKS = ("processing_timestamp", "error_timestamp")


def contents(rows):
    return sorted(str(row) for row in rows.drop(*CLOCKS).collect())


def ingest(spark, layers, folder, minute=0):
    now = F.timestamp_seconds(F.lit(1_704_000_000 + 60 * minute))
    finish(bronze_stage(layers, stream_trips(spark, str(folder), now=now)))


def test_csv_stream_has_origin_and_arrival(spark, layers, tmp_path):
    write_csv(tmp_path / "in" / "a.csv")
    finish(bronze_stage(layers, stream_trips(spark, str(tmp_path / "in"))))
    rows = layers.read("bronze_trips")
    assert rows.count() == len(TRIPS)
    assert rows.filter("source_file LIKE '%/a.csv'").count() == len(TRIPS)
    assert rows.select("ingestion_timestamp").distinct().count() == 1
    assert rows.filter("trip_id IS NULL").count() == 1


def test_malformed_lines_can_be_kept(spark, tmp_path):
    path = tmp_path / "in" / "a.csv"
    write_csv(path, "copy_1")
    path.write_text(path.read_text() + "Z,d1,1,too,short\n")
    rows = read_trips(spark, str(path.parent), keep_malformed=True).cache()
    assert [row.trip_id for row in rows.filter(F.col(MALFORMED).isNotNull()).collect()] == ["Z"]
    assert MALFORMED not in silver_trips(rows).columns


def test_columns_follow_the_header(spark, tmp_path):
    path = tmp_path / "in" / "a.csv"
    turned = list(reversed(RAW.names))
    write_csv(path, columns=turned)
    schema = csv_schema(spark, str(path.parent))
    assert schema.names == turned
    assert read_trips(spark, str(path.parent), schema).filter("trip_id = 'A'").count() == 2
    with pytest.raises(Exception, match="(?i)header"):
        read_trips(spark, str(path.parent)).collect()


def test_extra_columns_pass_through(spark, layers, tmp_path):
    path = tmp_path / "in" / "a.csv"
    write_csv(path, columns=[*RAW.names, "vendor"])
    schema = csv_schema(spark, str(path.parent))
    finish(bronze_stage(layers, stream_trips(spark, str(path.parent), schema)))
    finish(silver_stage(layers), error_stage(layers))
    assert "vendor" in layers.read("silver_trips").columns
    assert "vendor" in layers.read("error_log").columns


@pytest.mark.parametrize("per_batch", [1, 100])
def test_layers_equal_the_batch_result(spark, layers, tmp_path, per_batch):
    names = list(TRIPS)
    for number, part in enumerate((names[:1], names[1:5], names[5:9], names[9:])):
        write_csv(tmp_path / "in" / f"{number}.csv", *part)
        ingest(spark, layers, tmp_path / "in", minute=number)
    bronze = layers.read("bronze_trips")
    finish(silver_stage(layers, maxFilesPerTrigger=per_batch), error_stage(layers, maxFilesPerTrigger=per_batch))
    silver = layers.read("silver_trips")
    assert contents(silver) == contents(silver_trips(bronze))
    assert contents(layers.read("error_log")) == contents(errors.error_log(bronze))
    for table, aggregate in (
        ("gold_zone_revenue", gold.zone_revenue),
        ("gold_peak_hours", gold.peak_hours),
        ("gold_driver_perf", gold.driver_performance),
    ):
        finish(gold_stage(layers, table, maxFilesPerTrigger=per_batch))
        assert contents(layers.read(table)) == contents(aggregate(silver))


def test_restart_adds_only_what_is_new(spark, layers, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", "copy_1", "bad_first", "backwards")
    ingest(spark, layers, tmp_path / "in")
    finish(silver_stage(layers))
    before = contents(layers.read("silver_trips"))
    ingest(spark, layers, tmp_path / "in")
    finish(silver_stage(layers))
    assert contents(layers.read("silver_trips")) == before

    # Ids of an earlier batch stay out, also where a rule dropped their first copy.
    write_csv(tmp_path / "in" / "b.csv", "copy_2", "good_later", "low_total")
    ingest(spark, layers, tmp_path / "in")
    finish(silver_stage(layers))
    assert sorted(row.trip_id for row in layers.read("silver_trips").collect()) == ["A", "C", "G"]


@pytest.mark.parametrize("crash", ["before ids", "after ids", "after rows"])
def test_a_crash_neither_loses_nor_repeats_rows(spark, layers, tmp_path, monkeypatch, crash):
    write_csv(tmp_path / "in" / "a.csv")
    ingest(spark, layers, tmp_path / "in")
    store = exact._store_batch

    def failing(rows, table, batch_id):
        last = table.endswith("silver_trips")
        if crash == "before ids" or (crash == "after ids" and last):
            raise RuntimeError("lost")
        store(rows, table, batch_id)
        if last:
            raise RuntimeError("lost")

    monkeypatch.setattr(exact, "_store_batch", failing)
    with pytest.raises(StreamingQueryException):
        finish(silver_stage(layers))
    monkeypatch.setattr(exact, "_store_batch", store)
    if crash == "after rows":
        # An aggregate that has read the rows already must not see them a second time.
        finish(gold_stage(layers, "gold_peak_hours"))
    finish(silver_stage(layers))
    finish(gold_stage(layers, "gold_peak_hours"))
    expected = silver_trips(layers.read("bronze_trips"))
    assert contents(layers.read("silver_trips")) == contents(expected)
    assert contents(layers.read("gold_peak_hours")) == contents(gold.peak_hours(expected))


def test_a_partly_written_batch_is_replaced(spark, layers, tmp_path, monkeypatch):
    write_csv(tmp_path / "in" / "a.csv")
    ingest(spark, layers, tmp_path / "in")
    store = exact._store_batch

    def half(rows, table, batch_id):
        if table.endswith("silver_trips"):
            store(rows.filter("trip_id < 'D'"), table, batch_id)
            raise RuntimeError("lost")
        store(rows, table, batch_id)

    monkeypatch.setattr(exact, "_store_batch", half)
    with pytest.raises(StreamingQueryException):
        finish(silver_stage(layers))
    monkeypatch.setattr(exact, "_store_batch", store)
    gold_totals(layers, "gold_peak_hours")
    finish(silver_stage(layers))
    expected = silver_trips(layers.read("bronze_trips"))
    assert contents(layers.read("silver_trips")) == contents(expected)
    gold_totals(layers, "gold_peak_hours")
    assert contents(layers.read("gold_peak_hours")) == contents(gold.peak_hours(expected))


@pytest.mark.parametrize("per_batch", [1, 100])
def test_each_row_with_an_id_is_a_winner_or_a_duplicate(spark, layers, tmp_path, per_batch):
    # Two files in one raw batch, taken apart by pacing.
    write_csv(tmp_path / "in" / "z.csv", "copy_1", "bad_first", "backwards", "no_id_long")
    write_csv(tmp_path / "in" / "a.csv", "copy_2", "good_later", "low_total", "copy_1")
    ingest(spark, layers, tmp_path / "in")
    finish(silver_stage(layers, on_null="keep", rules={}, maxFilesPerTrigger=per_batch))
    rows = [(r.trip_id, r.source_file) for r in layers.read("bronze_trips").collect() if r.trip_id]
    winners = [(r.trip_id, r.source_file) for r in layers.read("silver_trips").collect()]
    copies = [(r.trip_id, r.source_file) for r in layers.read("duplicate_log").collect()]
    assert sorted(winners + copies) == sorted(rows) and len({i for i, _ in winners}) == len(winners)


def test_an_old_file_is_taken_in(spark, layers, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", "copy_1")
    ingest(spark, layers, tmp_path / "in")
    late = tmp_path / "in" / "b.csv"
    write_csv(late, "backwards")
    month_ago = late.stat().st_mtime - 30 * 86400
    os.utime(late, (month_ago, month_ago))
    ingest(spark, layers, tmp_path / "in", minute=1)
    assert sorted(r.trip_id for r in layers.read("bronze_trips").collect()) == ["A", "C"]


def test_a_later_column_reaches_the_tables(spark, layers, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", "copy_1")
    ingest(spark, layers, tmp_path / "in")
    finish(silver_stage(layers))
    write_csv(tmp_path / "more" / "b.csv", "backwards", columns=[*RAW.names, "vendor"])
    schema = csv_schema(spark, str(tmp_path / "more"))
    rows = stream_trips(spark, str(tmp_path / "more"), schema)
    table = layers.create("bronze_trips", rows.schema)
    assert "vendor" in spark.table(table).columns
    with pytest.raises(ValueError, match="trip_id"):
        layers.create("bronze_trips", rows.withColumn("trip_id", F.lit(1)).schema)


def test_odd_header_names_pass_through(spark, layers, tmp_path):
    path = tmp_path / "in" / "a.csv"
    write_csv(path, columns=[*RAW.names, "vendor id", "vendor.code"])
    schema = csv_schema(spark, str(path.parent))
    run_layers(layers, stream_trips(spark, str(path.parent), schema))
    for table in ("bronze_trips", "silver_trips", "error_log", "duplicate_log"):
        assert {"vendor id", "vendor.code"} <= set(layers.read(table).columns), table
    bronze = layers.read("bronze_trips")
    assert contents(layers.read("silver_trips")) == contents(silver_trips(bronze))


def test_strict_rows_are_all_accounted_for(spark, layers, tmp_path):
    write_csv(tmp_path / "in" / "a.csv")
    run_layers(layers, stream_trips(spark, str(tmp_path / "in")), on_null="drop")
    found = set()
    for table in ("silver_trips", "error_log", "duplicate_log"):
        found |= {r.trip_id for r in layers.read(table).collect()}
    assert found == {row[0] for row in TRIPS.values()}
    quality = layers.read("quality_log").first()
    assert (quality.row_count, quality.valid_speed_violations) == (10, 3)


def test_stored_columns_carry_no_watermark(spark, layers, tmp_path):
    write_csv(tmp_path / "in" / "a.csv")
    trips = stream_trips(spark, str(tmp_path / "in")).withWatermark("ingestion_timestamp", "10 minutes")
    finish(bronze_stage(layers, trips))
    files = spark.read.parquet(layers.location("bronze_trips"))
    assert all(not field.metadata for field in files.schema.fields)


def test_aggregates_without_watermark_cannot_append(spark, layers, tmp_path):
    write_csv(tmp_path / "in" / "a.csv")
    ingest(spark, layers, tmp_path / "in")
    finish(silver_stage(layers))
    hours = gold.peak_hours(layers.stream("silver_trips"))
    with pytest.raises(AnalysisException):
        hours.writeStream.outputMode("append").format("noop").option(
            "checkpointLocation", str(tmp_path / "checkpoint")
        ).start()


def state_dedup(spark, tmp_path, policy):
    """Three batches of one id, the last four hours later; gives the ids let through and the state kept."""
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    # Two ids at the start, the first one once more, others four hours later, and then the first again.
    arrivals = [("A", 0), ("B", 0)], [("A", 60)], [("C", 4 * 3600), ("D", 4 * 3600)], [("A", 4 * 3600 + 60)]
    bronze = frame(spark, "copy_1").limit(1)
    for batch in arrivals:
        times = spark.createDataFrame(batch, "trip_id string, seconds long")
        at = F.timestamp_seconds(F.col("seconds") + 1_704_000_000)
        rows = bronze.drop("trip_id").crossJoin(times).withColumn("ingestion_timestamp", at)
        rows.select(*BRONZE.names).write.mode("append").parquet(source)
        stream = stream_first_copies(spark.readStream.schema(BRONZE).parquet(source), policy=policy)
        query = (
            stream.writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start(target)
        )
        query.awaitTermination()
        state = [operator["numRowsTotal"] for operator in query.lastProgress["stateOperators"]]
    return sorted(row.trip_id for row in spark.read.parquet(target).collect()), state


def test_unbounded_state_keeps_all_ids(spark, tmp_path):
    ids, state = state_dedup(spark, tmp_path, "unbounded")
    assert ids == ["A", "B", "C", "D"]
    assert min(state) == 4


def test_bounded_state_forgets_old_ids(spark, tmp_path):
    ids, state = state_dedup(spark, tmp_path, "bounded")
    assert ids == ["A", "A", "B", "C", "D"]
    assert min(state) <= 3


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        stream_first_copies(frame(spark), policy="none")


def test_all_layers_in_one_run(spark, layers, tmp_path):
    write_csv(tmp_path / "in" / "a.csv")
    run_layers(layers, stream_trips(spark, str(tmp_path / "in")))
    row = layers.read("pipeline_log").first()
    assert (row.ProcessedRecordCount, row.InvalidAnomalyCount, row.DuplicateCount) == (7, 5, 2)
    assert (row.Status, row.FileName) == ("SUCCESS", "N/A") and row.RunId.startswith("Run-")
