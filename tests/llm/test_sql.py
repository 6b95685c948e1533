"""Queries that have SQL, against another engine."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
import pytest
from fareflow.llm import catalogue


@pytest.mark.parametrize("name", catalogue.ORACLES)
def test_matches_sql(spark, data, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    rows = catalogue.QUERIES[name](spark, data)
    expected = connection.execute(catalogue.ORACLES[name])
    columns = [column[0] for column in expected.description]
    assert sorted(rows.columns) == sorted(columns)
    assert Counter(tuple(row) for row in rows.select(*columns).collect()) == Counter(expected.fetchall())
