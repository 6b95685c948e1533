"""The raw layer stored by trip id: ranks without a shuffle by id, hot ids split, results as in a batch."""

import pytest
from golden import frame
from pyspark.sql import functions as F

from fareflow.operators import first_copies
from fareflow.plans.clustered import store_by_id, stored_duplicates, stored_firsts
from fareflow.plans.errors import duplicate_log
from fareflow.plans.silver import prepare


def contents(rows):
    return sorted(str(row) for row in rows.drop("error_timestamp").collect())


def many(spark, copies):
    """One id with very many copies that arrive at different times, and the usual rows."""
    hot = frame(spark, "copy_1", "good_later").limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    hot = hot.withColumn("ingestion_timestamp", F.timestamp_seconds(F.lit(1_704_000_000) + F.col("n") * 7919 % copies)).drop("n")
    return frame(spark).union(hot)


@pytest.mark.parametrize("hot_rows", [1, 5, 100, 10_000])
def test_stored_by_id_equals_the_batch(spark, layers, hot_rows):
    bronze = many(spark, 400)
    store_by_id(layers, bronze, hot_rows=hot_rows, buckets=4)
    assert contents(stored_firsts(layers)) == contents(first_copies(prepare(bronze)))
    assert contents(stored_duplicates(layers)) == contents(duplicate_log(bronze))


def test_no_shuffle_by_id_but_of_hot_ids(spark, layers):
    store_by_id(layers, many(spark, 400), hot_rows=50, buckets=4)
    table = spark.table(layers.name("bronze_by_id"))
    # The hot id lies in several buckets.
    assert table.filter("hot").select("slice").distinct().count() == 9
    assert table.filter("trip_id = 'A'").select(F.input_file_name()).distinct().count() > 1
    for rows in (stored_firsts(layers), stored_duplicates(layers)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
        assert len(exchanges) == 1 and plan.count("Bucketed: true") == 2
        # What is shuffled are rows of hot ids, and of each slice only the first one.
        assert "EqualTo(hot,true)" in described(rows)


def described(rows):
    return rows._sc._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
