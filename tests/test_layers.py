"""Tables, their properties, and the logs about runs."""

import os

import pytest
from golden import frame
from pyspark.sql import functions as F

from fareflow.operators import zone_lookup
from fareflow.plans import errors
from fareflow.plans.logs import append_layer_counts, stored_log, tracked_run
from fareflow.plans.silver import silver_trips
from fareflow.schema import RUN_LOG
from fareflow.session import shared_folder
from fareflow.sources import TABLES
from fareflow.sources.layers import drop_partitions


def described(spark, name):
    return {row.col_name: row.data_type for row in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}


@pytest.mark.parametrize("table", TABLES)
def test_tables_have_comment_and_quality(spark, layers, table):
    name = layers.create(table)
    layers.create(table)
    found = described(spark, name)
    assert found["Comment"] == TABLES[table].comment
    if TABLES[table].quality:
        assert f"quality={TABLES[table].quality}" in found["Table Properties"]
    names = [column for column in spark.table(name).columns if column != "batch_id"]
    assert names == TABLES[table].schema.names


def test_overwrite_replaces_rows_and_keeps_properties(spark, layers):
    name = layers.create("gold_peak_hours")
    for hour in (1, 2):
        rows = spark.sql(f"SELECT {hour} AS pickup_hour, 1L AS trips, current_timestamp() AS processing_timestamp")
        layers.overwrite(rows, "gold_peak_hours")
    assert [row.pickup_hour for row in layers.read("gold_peak_hours").collect()] == [2]
    assert "quality=gold" in described(spark, name)["Table Properties"]


def test_lookup_as_a_table(spark, layers):
    layers.create("zone_lookup")
    layers.overwrite(zone_lookup(spark), "zone_lookup")
    stored = {row.zone_name: row.zone_id for row in layers.read("zone_lookup").collect()}
    assert stored["Bronx"] == "Zone-01" and stored["Staten Island"] == "Zone-05" and len(stored) == 5


def test_run_log(spark, layers):
    def broken():
        raise RuntimeError("no space")

    assert tracked_run(layers, "p", "u1", lambda: None) == "SUCCESS"
    assert tracked_run(layers, "p", "u2", broken) == "FAILED"
    log = layers.read("run_log")
    assert log.columns == RUN_LOG.names
    rows = {row.UpdateId: row for row in log.collect()}
    assert (rows["u1"].Status, rows["u1"].ErrorMessage) == ("SUCCESS", None)
    assert (rows["u2"].Status, rows["u2"].ErrorMessage) == ("FAILED", "no space")
    assert all(row.RunId.startswith("RUN-") and row.EndTimeIST >= row.StartTimeIST for row in rows.values())


def fill(spark, layers):
    trips = frame(spark)
    layers.create("error_log")
    layers.overwrite(errors.error_log(trips), "error_log")
    for table, rows in (("duplicate_log", errors.duplicate_log(trips)), ("silver_trips", silver_trips(trips))):
        name = layers.create(table)
        rows.withColumn("batch_id", F.lit(0)).select(*spark.table(name).columns).write.insertInto(name)


def test_tables_by_batch_are_not_overwritten_as_a_whole(layers):
    layers.create("duplicate_log")
    with pytest.raises(ValueError, match="duplicate_log"):
        layers.overwrite(layers.read("duplicate_log"), "duplicate_log")


def test_old_versions_are_removed_but_the_one_before(spark, layers):
    name = layers.create("gold_peak_hours")
    for hour in range(5):
        before = spark.table(name).inputFiles()
        layers.overwrite(spark.sql(f"SELECT {hour} AS pickup_hour, 1L AS trips, current_timestamp() AS processing_timestamp"), "gold_peak_hours")
    assert len(os.listdir(layers.location("gold_peak_hours") + "_versions")) == 2
    assert before and all(os.path.exists(path.removeprefix("file://")) for path in before)


def test_layer_counts_are_appended(spark, layers):
    fill(spark, layers)
    append_layer_counts(layers)
    append_layer_counts(layers, file_name="a.csv")
    rows = layers.read("layer_counts").orderBy("RunId").collect()
    counts = [(row.ProcessedRecordCount, row.InvalidAnomalyCount, row.DuplicateCount) for row in rows]
    assert counts == [(7, 5, 2)] * 2
    assert [row.FileName for row in rows] == ["N/A", "a.csv"]


def test_failed_append_is_tried_again_as_failed(spark, layers, monkeypatch):
    fill(spark, layers)
    append, calls = layers.append, []

    def once(rows, table):
        calls.append(table)
        if len(calls) == 1:
            raise RuntimeError("busy")
        append(rows, table)

    monkeypatch.setattr(layers, "append", once)
    append_layer_counts(layers)
    assert [row.Status for row in layers.read("layer_counts").collect()] == ["FAILED"]


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first.startswith(base) and first != second


def test_stored_layers_are_counted_from_footers(spark, layers):
    fill(spark, layers)
    log = stored_log(layers)
    row = log.first()
    assert (row.ProcessedRecordCount, row.InvalidAnomalyCount, row.DuplicateCount) == (7, 5, 2)
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 3 and "ReadSchema: struct<count(*):bigint>" in plan


def test_dropped_partitions_leave_no_files(spark, layers):
    fill(spark, layers)
    name = layers.name("silver_trips")
    drop_partitions(spark, name, batch_id=3)
    assert spark.table(name).count() == 7
    drop_partitions(spark, name, batch_id=0)
    spark.catalog.refreshTable(name)
    assert spark.table(name).count() == 0 and "batch_id=0" not in os.listdir(layers.location("silver_trips"))
    assert stored_log(layers).first().ProcessedRecordCount == 0
