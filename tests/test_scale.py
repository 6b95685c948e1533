"""Work that is spread over tasks: no file, task or batch takes in more as the tables grow."""

import pytest
from pyspark.sql import functions as F

from fareflow.plans import catalogue
from fareflow.schema import RAW, SANITIZED
from fareflow.sources.layers import replace_rows
from fareflow.streaming import exact, ranked, stages


def lineitem(spark, path, rows=300, parts=3):
    """A table of line items of its own, in several files; every fifth row repeats an id."""
    i = F.col("id")
    number = F.when(i % 5 == 0, F.lit(0)).otherwise(i)
    spark.range(0, rows, 1, parts).select(
        number.alias("l_orderkey"),
        (i + 1).alias("l_partkey"),
        i.alias("l_suppkey"),
        F.lit(1).cast("long").alias("l_linenumber"),
        (i % 30).cast("double").alias("l_quantity"),
        (i * 1.5).alias("l_extendedprice"),
        F.lit(0.05).alias("l_discount"),
        F.lit("A").alias("l_returnflag"),
        (F.lit("1995-01-01").cast("timestamp_ntz") + F.make_dt_interval((i * 5).cast("int"))).alias("l_shipdate"),
    ).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_broken_lines_lie_in_several_files_with_a_header_each(spark, tmp_path):
    folder = lineitem(spark, tmp_path / "in")
    catalogue._mixed_landing(spark, folder, str(tmp_path / "landing"))
    texts = [path.read_text().splitlines() for path in (tmp_path / "landing").glob("*.txt")]
    texts = [lines for lines in texts if lines]
    assert len(texts) == 3
    assert all(lines[0] == ",".join(RAW.names) and lines.count(lines[0]) == 1 for lines in texts)
    ledger = {row.kind: row for row in catalogue.bronze_ledger(spark, folder).collect()}
    assert ledger["broken"].rows_read == ledger["broken"].malformed == sum(len(lines) - 1 for lines in texts) == 90


def _trips(spark, ids, parts, minute, number=0):
    """Raw trips of these ids, each a minute later than the one before it."""
    rows = [(trip, f"d{number + i}", *["1"] * 9, "f", i) for i, trip in enumerate(ids)]
    names = [*RAW.names, "source_file", "at"]
    rows = spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), ", ".join(f"{n} {'int' if n == 'at' else 'string'}" for n in names))
    return rows.withColumn("ingestion_timestamp", F.timestamp_seconds(1_704_000_000 + 60 * (F.col("at") + minute))).drop("at")


@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
def test_hot_ids_in_slices_keep_one_first_copy(spark, tmp_path, hot_rows):
    first = _trips(spark, ["H"] * 40 + ["A", "B", "B", None, "C"] * 3, 6, 0)
    sizes = ranked.slot_sizes(first)
    assert sum(sizes.values()) == 52 and ranked.is_hot(sizes, hot_rows) == (hot_rows == 5)
    stored = ranked.store_ranked(first, None, sizes, str(tmp_path / "a"), hot_rows)
    if hot_rows == 5:
        assert stored.filter("trip_id = 'H'").select("_slice").distinct().count() > 1
    new, copies = ranked.split_ranked(stored, ranked.is_hot(sizes, hot_rows))
    assert sorted((row.trip_id, row.driver_id) for row in new.collect()) == [("A", "d40"), ("B", "d41"), ("C", "d44"), ("H", "d0")]
    assert copies.count() == 48 and copies.columns == SANITIZED.names
    # The index may hold an id twice, and an id taken in before has no first copy.
    seen = spark.createDataFrame([("H",), ("H",), ("A",)], "trip_id string")
    stored = ranked.store_ranked(first, seen, sizes, str(tmp_path / "b"), hot_rows)
    new, copies = ranked.split_ranked(stored, ranked.is_hot(sizes, hot_rows))
    assert sorted(row.trip_id for row in new.collect()) == ["B", "C"]
    assert copies.count() == 50


def test_rows_of_a_batch_are_shuffled_once(spark, tmp_path, monkeypatch):
    rows = _trips(spark, [f"T{i % 50}" for i in range(100)], 4, 0)
    plans = []
    monkeypatch.setattr(ranked, "without_metadata", lambda frame: plans.append(frame) or frame)
    seen = spark.createDataFrame([(f"T{i}",) for i in range(30)], "trip_id string")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked.store_ranked(rows, seen, ranked.slot_sizes(rows), str(tmp_path / "a"))
        plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    # One shuffle of the rows and one of the ids taken in.
    assert plan.count("Exchange hashpartitioning") == 2


def test_ranking_takes_more_tasks_for_more_rows(spark, tmp_path, monkeypatch):
    rows = _trips(spark, [f"T{i % 150}" for i in range(200)], 4, 0)
    seen = spark.createDataFrame([(f"T{i}",) for i in range(30)], "trip_id string")
    sizes, plans = ranked.slot_sizes(rows), []
    monkeypatch.setattr(ranked, "without_metadata", lambda frame: plans.append(frame) or frame)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = ranked.store_ranked(rows, seen, sizes, str(tmp_path / "a"))
        many = ranked.store_ranked(rows, seen, sizes, str(tmp_path / "b"), task_rows=10)
        plan = plans[1]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    # Session: 4 partitions.
    assert len(few.inputFiles()) <= 4 and 10 < len(many.inputFiles()) <= 20
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    # One shuffle of the rows and one of the ids taken in, to as many tasks.
    assert plan.count("REPARTITION_BY_NUM") == plan.count("Exchange") == 2


def test_rows_of_a_batch_are_not_sorted_to_be_written(spark, layers):
    session = spark.newSession()
    hours, ids = layers.create("hour_sums"), layers.create("seen_ids")
    for batch_id, first in ((0, 1), (1, 5), (1, 7)):
        exact._store_batch(session.sql(f"SELECT {first} AS pickup_hour, 2L AS trips"), hours, batch_id)
    rows = session.range(0, 100, 1, 2).select(F.col("id").cast("string").alias("trip_id"), (F.col("id") % 16).cast("int").alias("bucket"))
    assert exact._store_batch(rows, ids, 0) == 100
    for table, columns in ((hours, "pickup_hour, trips, batch_id"), (ids, "trip_id, bucket, batch_id")):
        plan = session.sql(f"EXPLAIN INSERT OVERWRITE {table} SELECT {columns} FROM {table}").first()[0]
        assert "WriteFiles" in plan and "Sort" not in plan
    assert sorted((r.batch_id, r.pickup_hour) for r in session.table(hours).collect()) == [(0, 1), (1, 7)]
    assert session.table(ids).count() == 100 and session.table(ids).filter("bucket <> cast(trip_id AS int) % 16").isEmpty()


def test_running_totals_take_in_one_batch_for_each_run(spark, tmp_path, monkeypatch):
    folder, batches = lineitem(spark, tmp_path / "in", parts=8), []
    monkeypatch.setattr(stages, "replace_rows", lambda rows, name, location: batches.append(name) or replace_rows(rows, name, location))
    found = {tuple(row) for row in catalogue.stream_gold_complete(spark, folder).collect()}
    assert len(batches) == 2
    assert found == {tuple(row) for row in catalogue.gold_peak_hours(spark, folder).collect()}


def test_counts_are_packed_and_added_in_steps(spark):
    def count(slices, counts):
        for part in slices:
            for n in part["id"]:
                counts[n] += 3_000_000_000 if n == 7 else 1

    from fareflow.llm.common import COUNTS_AT_ONCE, tree_sum

    size = 3 * COUNTS_AT_ONCE + 5
    ids = spark.range(0, 40, 1, 20).select(F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.lit(size) - F.col("id")).alias("id"))
    total = tree_sum(ids, (size,), count)
    assert total[7] == 0xFFFFFFFF and total.sum() == 0xFFFFFFFF + 20 and total[size - 39] == 1
