"""Event time, keyed totals, progress of stages, the id index, and files with headers of their own."""

import os

import pytest
from golden import TRIPS, frame, write_csv
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from fareflow.plans import gold
from fareflow.plans.logs import tracked_run
from fareflow.plans.silver import silver_trips
from fareflow.schema import MALFORMED, RAW, SILVER
from fareflow.sources import file_ledger, stream_trips
from fareflow.streaming import (
    StageStopped,
    bronze_stage,
    error_stage,
    finish,
    follow,
    keyed_stage,
    late_trips,
    read_keyed,
    rescued_stage,
    run_layers,
    seen,
    silver_stage,
    upsert,
    window_stage,
)
from fareflow.streaming.progress import stopped_early


def add_silver(spark, layers, batch, trips):
    """Put trips of (id, zone, driver, hour, minute) into the cleaned layer, as a batch of it."""
    name = layers.create("silver_trips")
    rows = spark.createDataFrame(trips, "trip_id string, pickup_zone string, driver_id string, hour double, total_amount double")
    pickup = F.timestamp_seconds(1_704_067_200 + F.col("hour") * 3600)
    rows = rows.withColumn("pickup_datetime", pickup).drop("hour")
    others = [f.name for f in SILVER if f.name not in rows.columns]
    types = {f.name: f.dataType for f in SILVER}
    rows = rows.withColumns({c: F.lit(None).cast(types[c]) for c in others}).withColumn("batch_id", F.lit(batch))
    rows.select(*spark.table(name).columns).write.insertInto(name)


def windows(layers):
    follow(layers, zone_hours=window_stage(layers))
    return sorted((r.window_start.hour, r.pickup_zone or "", r.trips) for r in layers.read("zone_hours").collect())


def test_windows_close_and_late_trips_are_counted(spark, layers):
    add_silver(spark, layers, 0, [("a", "Q", "d", 0.5, 1.0), ("b", "Q", "d", 0.9, 1.0), ("c", None, "d", 1.05, 1.0), ("n", "Q", "d", None, 1.0)])
    # The mark is ten minutes before the latest trip, so the first hour is still open.
    assert windows(layers) == []
    add_silver(spark, layers, 1, [("e", "Q", "d", 0.95, 1.0), ("f", "B", "d", 3.0, 1.0)])
    assert windows(layers) == [(0, "Q", 3), (1, "", 1)]
    assert late_trips(layers).count() == 0
    # One for a window that is stored, two for a window that nobody had a trip in, one in time.
    add_silver(spark, layers, 2, [("g", "Q", "d", 0.1, 1.0), ("h", "B", "d", 1.2, 1.0), ("i", "B", "d", 1.3, 1.0), ("j", "Q", "d", 2.9, 1.0)])
    add_silver(spark, layers, 2, [("k", "Q", "d", 5.0, 1.0)])
    assert windows(layers) == [(0, "Q", 3), (1, "", 1), (2, "Q", 1), (3, "B", 1)]
    late = sorted((r.window_start.hour, r.pickup_zone, r.late) for r in late_trips(layers).collect())
    assert late == [(0, "Q", 1), (1, "B", 2)]
    log = layers.read("progress_log").filter("status = 'BATCH'").orderBy("batch").collect()
    # Windows that are stored leave the state.
    assert log[-1].state_rows == 1 and max(r.state_rows for r in log) >= 3
    assert max(r.late_groups for r in log) == 2
    assert log[-1].watermark.hour == 4


def test_keyed_totals_touch_only_parts_with_changes(spark, layers):
    add_silver(spark, layers, 0, [(f"t{i}", "Q", f"d{i % 40}", 1.0, float(i)) for i in range(200)])
    finish(keyed_stage(layers, "driver_totals"))
    first = upsert._versions(spark, layers.name("driver_totals_commits"), "driver_totals")[0]
    assert set(first.values()) == {0}
    add_silver(spark, layers, 1, [("x", "Q", "d7", 1.0, 5.0), ("y", "Q", None, 1.0, None), ("z", "Q", None, 1.0, 3.0)])
    finish(keyed_stage(layers, "driver_totals"))
    add_silver(spark, layers, 2, [("w", "Q", None, 1.0, 9.0)])
    finish(keyed_stage(layers, "driver_totals"))
    last = upsert._versions(spark, layers.name("driver_totals_commits"), "driver_totals")[0]
    assert sorted(last.values()).count(0) >= len(first) - 2 and max(last.values()) == 2
    assert totals(read_keyed(layers, "driver_totals")) == totals(gold.driver_performance(layers.read("silver_trips")))


def totals(rows):
    return sorted(str(row) for row in rows.drop("processing_timestamp").collect())


@pytest.mark.parametrize("crash", ["rows", "commit", "removal"])
def test_keyed_totals_after_a_crash(spark, layers, monkeypatch, crash):
    add_silver(spark, layers, 0, [(f"t{i}", "Q", f"d{i % 9}", 1.0, float(i)) for i in range(60)])
    finish(keyed_stage(layers, "zone_totals"))
    before = totals(read_keyed(layers, "zone_totals"))
    add_silver(spark, layers, 1, [("x", "Q", "d7", 1.0, 5.0), ("y", None, "d1", 1.0, 2.0)])
    store, remove = upsert._store_batch, upsert._remove_old

    def failing(rows, table, batch_id):
        if crash == "rows" or table.endswith("_commits"):
            raise RuntimeError("lost")
        return store(rows, table, batch_id)

    def broken(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(*((upsert, "_remove_old", broken) if crash == "removal" else (upsert, "_store_batch", failing)))
    with pytest.raises(StreamingQueryException):
        finish(keyed_stage(layers, "zone_totals"))
    after = totals(gold.zone_revenue(layers.read("silver_trips")))
    # Readers see the batch as a whole or not at all.
    assert totals(read_keyed(layers, "zone_totals")) == (after if crash == "removal" else before)
    monkeypatch.setattr(upsert, "_store_batch", store)
    monkeypatch.setattr(upsert, "_remove_old", remove)
    finish(keyed_stage(layers, "zone_totals"))
    assert totals(read_keyed(layers, "zone_totals")) == after


def test_a_batch_opens_only_buckets_that_can_hold_its_ids(spark, layers):
    name = layers.create("seen_ids")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for batch in range(4):
            ids = spark.range(batch * 5000, (batch + 1) * 5000).select(F.concat(F.lit("T"), "id").alias("trip_id"))
            ids = ids.withColumns({"bucket": seen.bucket_of("trip_id"), "batch_id": F.lit(batch).cast("long")})
            seen.in_buckets(ids).select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    asked = spark.createDataFrame([("T1",), ("T7000",), ("new",)], "trip_id string").withColumn("bucket", seen.bucket_of("trip_id"))
    measured = asked.agg(*seen.touched_buckets()).first().asDict()
    found = seen.earlier_ids(spark.table(name), asked, measured, 4)
    assert sorted(r.trip_id for r in found.collect()) == ["T1", "T7000"]
    # One file for each batch in each of at most three buckets.
    opened = [f for f in spark.table(name).filter(F.col("bucket").isin(measured["buckets"])).inputFiles()]
    assert len(opened) == 4 * len(measured["buckets"]) and len(spark.table(name).inputFiles()) == 4 * seen.BUCKETS
    assert scanned(found) <= 4 * 3 * 200
    seen.compact(layers)
    spark.catalog.refreshTable(name)
    assert len(spark.table(name).inputFiles()) == 2 * seen.BUCKETS
    assert spark.table(name).count() == 20_000
    found = seen.earlier_ids(spark.table(name), asked, measured, 4)
    assert sorted(r.trip_id for r in found.collect()) == ["T1", "T7000"]


def scanned(rows):
    """Rows that the scans of the index give out, by the plan as it ran."""
    rows.collect()
    plan, total = [rows._jdf.queryExecution().executedPlan()], 0
    while plan:
        node = plan.pop()
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        for kind in ("executedPlan", "plan"):
            if hasattr(node, kind) and node.nodeName() in ("AdaptiveSparkPlan", "ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage"):
                try:
                    plan.append(getattr(node, kind)())
                except Exception:
                    continue
        children = node.children()
        plan += [children.apply(i) for i in range(children.size())]
    return total


def test_small_batches_and_history_of_ids(spark, layers, tmp_path):
    for number, names in enumerate((["copy_1", "bad_first"], ["copy_2", "low_total"], ["good_later", "junk"])):
        write_csv(tmp_path / "in" / f"{number}.csv", *names)
        finish(bronze_stage(layers, stream_trips(spark, str(tmp_path / "in"))))
        finish(silver_stage(layers, rules={}))
        seen.compact(layers)
    assert sorted(r.trip_id for r in layers.read("silver_trips").collect()) == ["A", "D", "F", "G"]
    assert sorted(r.trip_id for r in layers.read("duplicate_log").collect()) == ["A", "F"]
    assert sorted(r.trip_id for r in layers.read("seen_ids").collect()) == ["A", "D", "F", "G"]


def test_progress_of_each_batch(spark, layers, tmp_path):
    for number in range(3):
        write_csv(tmp_path / "in" / f"{number}.csv", *list(TRIPS)[number * 4 : number * 4 + 4])
    follow(layers, bronze_trips=bronze_stage(layers, stream_trips(spark, str(tmp_path / "in"), maxFilesPerTrigger=1)))
    follow(layers, silver_trips=silver_stage(layers), error_log=error_stage(layers))
    log = layers.read("progress_log").collect()
    assert sorted(r.input_rows for r in log if r.stage == "bronze_trips" and r.status == "BATCH") == [4, 4, 4]
    assert {(r.stage, r.status) for r in log if r.batch is None} == {(s, "COMPLETED") for s in ("bronze_trips", "silver_trips", "error_log")}


def test_a_stopped_stage_is_no_success(spark, layers, tmp_path, monkeypatch):
    write_csv(tmp_path / "in" / "a.csv")
    trips = stream_trips(spark, str(tmp_path / "in"))
    running = []

    def slow(batch, batch_id):
        # Somebody stops the query while this batch runs.
        running[0].stop()

    def work():
        layers.create("bronze_trips", trips.schema)
        query = trips.writeStream.foreachBatch(slow).option("checkpointLocation", layers.checkpoint("bronze_trips"))
        running.append(query.start())
        follow(layers, bronze_trips=running[0])

    with pytest.raises((StageStopped, StreamingQueryException)):
        work()
    assert stopped_early(layers, "bronze_trips")
    running.clear()
    assert tracked_run(layers, "p", "u", work) == "FAILED"
    ends = [r.status for r in layers.read("progress_log").collect() if r.batch is None]
    assert "COMPLETED" not in ends and len(ends) == 2


def test_files_with_headers_of_their_own(spark, layers, tmp_path):
    folder = tmp_path / "in"
    write_csv(folder / "a.csv", "copy_1", "fast")
    write_csv(folder / "b.csv", "backwards", columns=["vendor", *reversed(RAW.names)])
    header = ",".join(RAW.names)
    (folder / "c.csv").write_text(f'{header}\n\nZ,d1,1,too,short\n{",".join(["Y"] * 11)},more\n"X, ""y""",d\n')
    (folder / "d.csv").write_text('trip_id,note,note,fare_amount\nW,"a, b",c,5\n')
    finish(rescued_stage(layers, str(folder)))
    rows = {r.trip_id: r for r in layers.read("bronze_rescued").collect()}
    assert sorted(rows) == ["A", "B", "C", "W", 'X, "y"', "Y", "Z"]
    assert rows["C"].pickup_zone == "Queens" and rows["C"].dropoff_zone == "Bronx" and rows["C"].rescued == {}
    assert rows["W"].rescued == {"note": "c"} and rows["W"].fare_amount == "5" and rows["W"].tip_amount is None
    assert rows["Z"][MALFORMED] == "Z,d1,1,too,short" and rows["Z"].dropoff_datetime == "short"
    assert rows["Y"][MALFORMED].endswith(",more") and rows["Y"].total_amount == "Y"
    assert all(rows[i][MALFORMED] is None for i in "ABCW")
    ledger = {os.path.basename(r.source_file): r for r in file_ledger(layers.read("bronze_rescued")).collect()}
    assert [(ledger[f].rows_read, ledger[f].malformed, ledger[f].with_rescued) for f in ("a.csv", "b.csv", "c.csv", "d.csv")] == [
        (2, 0, 0), (1, 0, 0), (3, 3, 0), (1, 0, 1),
    ]
    # Later files are a batch of their own.
    write_csv(folder / "e.csv", "junk", columns=[*RAW.names[::-1]])
    finish(rescued_stage(layers, str(folder)))
    assert layers.read("bronze_rescued").count() == 8
    good = layers.read("bronze_rescued").filter(F.col(MALFORMED).isNull()).drop("rescued")
    assert {r.trip_id for r in silver_trips(good).collect()} >= {"A", "C"}


def test_runs_of_all_layers_are_logged(spark, layers, tmp_path):
    write_csv(tmp_path / "in" / "a.csv")
    run_layers(layers, stream_trips(spark, str(tmp_path / "in")))
    stages = {r.stage for r in layers.read("progress_log").filter("status = 'COMPLETED'").collect()}
    assert stages == {"bronze_trips", "silver_trips", "error_log"}
    assert frame(spark).count() == layers.read("bronze_trips").count()
