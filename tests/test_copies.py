"""Ranking of copies: against brute force, with frequent keys, and the shape of the plans."""

import re
from collections import Counter
from contextlib import contextmanager

import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as examples
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fareflow.operators import first_copies, later_copies, unseen
from fareflow.plans import errors
from fareflow.plans.silver import prepare, silver_trips
from fareflow.sources import raw_trips

ROWS = st.lists(
    st.tuples(st.sampled_from([None, "a", "b", "c", "d"]), st.integers(0, 3), st.sampled_from([None, "x", "y"])),
    max_size=25,
)


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "trip_id string, ingestion_timestamp int, payload string").repartition(parts)


def split_copies(rows):
    """First and later copies in plain Python."""
    rank = lambda row: (row[1], row[2] is not None, row[2] or "")
    first, later = Counter(), Counter()
    for key in {row[0] for row in rows} - {None}:
        copies = sorted((row for row in rows if row[0] == key), key=rank)
        first[copies[0]] += 1
        later.update(copies[1:])
    return first, later


@examples(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_ranking_matches_brute_force(spark, rows):
    first, later = split_copies(rows)
    trips = frame(spark, rows)
    assert Counter(map(tuple, first_copies(trips).collect())) == first
    assert Counter(map(tuple, later_copies(trips).collect())) == later


def test_exact_copies_of_one_row(spark):
    rows = [("hot", 1, "x")] * 500 + [(f"t{n}", n, "y") for n in range(1000)]
    trips = frame(spark, rows, 8)
    assert first_copies(trips).count() == 1001
    assert later_copies(trips).count() == 499


def test_unseen(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "trip_id string, n int")
    seen = spark.createDataFrame([("a",), ("a",), ("z",)], "trip_id string")
    assert sorted(row.trip_id for row in unseen(rows, seen).collect()) == ["b", "c"]


def plan(rows):
    return rows._jdf.queryExecution().toString()


@pytest.fixture
def hot(spark, data):
    """Raw trips in 16 splits, where one id holds a third of all rows."""
    raw = raw_trips(spark.read.parquet(f"{data}/lineitem.parquet"))
    third = F.xxhash64("trip_id", "fare_amount") % 3 == 0
    return raw.withColumn("trip_id", F.when(third, F.lit("hot")).otherwise(F.col("trip_id"))).repartition(16)


def test_first_copies_are_cut_down_before_the_shuffle(spark, hot):
    text = plan(first_copies(prepare(hot)))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


@contextmanager
def configured(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in names:
            spark.conf.unset(name)


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_a_frequent_id_is_ranked_in_small_groups(spark, hot, broadcast):
    """No group of either window holds more than one split, or one row per split."""
    # Tables this small would otherwise be merged into one task.
    apart = {"spark__sql__adaptive__coalescePartitions__enabled": "false"}
    with configured(spark, spark__sql__autoBroadcastJoinThreshold=broadcast, **apart):
        logged = errors.duplicate_log(hot)
        text = plan(logged).split("== Physical Plan ==")[1]
        assert re.search(r"hashpartitioning\(trip_id#\d+, _split#\d+", text)
        assert re.search(r"hashpartitioning\(trip_id#\d+, _group#\d+", text)
        # 2000 copies come from 16 splits: the log has them in several tasks, none with most of them.
        tasks = logged.filter("trip_id = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        sizes = [row["count"] for row in tasks]
        assert sum(sizes) > 1800 and len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)


def test_a_frequent_id_is_split_in_the_join(spark, hot, tmp_path):
    hot.write.parquet(str(tmp_path / "hot"))
    small = {
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "50KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    }
    with configured(spark, **small):
        logged = errors.duplicate_log(spark.read.parquet(str(tmp_path / "hot")))
        logged.collect()
        assert "SortMergeJoin(skew=true)" in plan(logged)


def test_no_cross_joins_or_python_in_the_plans(spark, data):
    from fareflow.plans.logs import pipeline_log

    raw = raw_trips(spark.read.parquet(f"{data}/lineitem.parquet"))
    text = plan(pipeline_log(silver_trips(raw), errors.error_log(raw), errors.duplicate_log(raw)))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert operator not in text


def test_zone_join_is_a_broadcast_and_scans_are_pruned(spark, data):
    raw = raw_trips(spark.read.parquet(f"{data}/lineitem.parquet"))
    text = plan(silver_trips(raw)).split("== Physical Plan ==")[1]
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "l_tax" not in text and "l_linestatus" not in text


def test_error_log_reads_its_input_once(spark, data):
    raw = raw_trips(spark.read.parquet(f"{data}/lineitem.parquet"))
    text = plan(errors.error_log(raw)).split("== Physical Plan ==")[1]
    assert text.count("FileScan") == 1 and "Exchange" not in text
