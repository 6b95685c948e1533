from __future__ import annotations

import random
from collections import defaultdict

from fareflow.llm import exact_dedup
from pyspark.sql import functions as F

from .brute import sha256


def test_small_blocks_over_many_levels(spark):
    rng = random.Random(3)
    texts = [None, "", "ab", "abab", "abababab", "abababa", "ü" * 9, "x" * 4096] + [
        "".join(rng.choice("ab") for _ in range(rng.randint(0, 9))) for _ in range(400)
    ]
    texts += texts[:50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = exact_dedup.exact_duplicates(docs, block_bytes=4).collect()
    groups = defaultdict(list)
    for i, text in enumerate(texts):
        groups[text or ""].append(i)
    assert len(rows) == len(texts)
    for r in rows:
        same = groups[texts[r.doc_id] or ""]
        assert (r.keep_id, r.group_size, r.kept) == (max(same), len(same), r.doc_id == max(same))
        assert r.text_sha256 == sha256(texts[r.doc_id] or "")


def test_blocks_are_forgotten_and_met_again(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "KEPT_BYTES", 2000)
    rng = random.Random(8)
    texts = ["".join(rng.choice(("aaaa", "bbbb", "cccc", "dddd", f"{rng.randrange(99):04d}")) for _ in range(5)) for _ in range(900)]
    texts += texts[:300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    groups = defaultdict(list)
    for i, text in enumerate(texts):
        groups[text].append(i)
    for r in exact_dedup.exact_duplicates(docs, block_bytes=4).collect():
        assert (r.keep_id, r.group_size) == (max(groups[texts[r.doc_id]]), len(groups[texts[r.doc_id]]))


def test_a_hot_block_is_sent_once_by_a_partition(spark):
    docs = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.repeat(F.lit("copy "), 1000)).otherwise(F.col("id").cast("string")).alias("text"))
    cut = exact_dedup._cut(exact_dedup.row_keys(docs.coalesce(2)).select("id", "text", *exact_dedup.ROW), 8192)
    assert cut.filter("length(content) = 5000").count() <= 2


def test_one_text_in_a_third_of_all_rows(spark, tmp_path):
    path = str(tmp_path / "docs")
    text = F.when(F.col("id") % 3 == 0, F.repeat(F.lit("copy "), 5000)).otherwise(F.col("id").cast("string"))
    spark.range(1500).select(F.col("id").alias("doc_id"), text.alias("text")).write.parquet(path)
    rows = exact_dedup.exact_duplicates(spark.read.parquet(path))
    assert rows.filter("group_size = 500").count() == 500
    assert rows.filter("kept").count() == 1001
    assert {r.keep_id for r in rows.filter("group_size = 500").collect()} == {1497}


def test_missing_and_repeated_ids_and_clashing_columns(spark):
    rows = [(None, "a", 1), (2, "a", 1), (2, "a", 1), (None, "b", 2), (None, "b", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, name int").withColumn("sha", F.lit(0))
    found = exact_dedup.exact_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size) for r in found) == [(0, 0, 2), (0, 0, 2), (0, 2, 3), (2, 2, 3), (2, 2, 3)]
    assert sum(r.kept for r in found) == 2
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0
