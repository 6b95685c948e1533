"""Every query against its SQL counterpart in another engine."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from fareflow.plans.catalogue import QUERIES
from fareflow.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def oracle(data):
    connection = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, data, oracle, name):
    rows = QUERIES[name](spark, data)
    expected = oracle.execute(ORACLES[name])
    columns = [column[0] for column in expected.description]
    assert sorted(rows.columns) == sorted(columns)
    found = Counter(tuple(row) for row in rows.select(*columns).collect())
    assert found == Counter(expected.fetchall())


def test_entry(spark, data):
    assert contract.entry(spark).columns == ["pickup_hour", "trips"]
