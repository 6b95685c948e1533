from __future__ import annotations

import zlib
from collections import Counter

from fareflow.llm import catalogue, shard_tree
from pyspark.sql import functions as F


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    rows = catalogue.QUERIES["op10_shard_tree"](spark, folder).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    by_shard: dict[int, list[int]] = {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 24)
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert set(by_shard) == set(range(24))
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


def test_shares_follow_weights_and_growth_takes_rows_only_for_itself(spark):
    tree = [shard_tree.Leaf("a", "a1", 0, 1.0), shard_tree.Leaf("a", "a2", 1, 2.0), shard_tree.Leaf("b", "b1", 2, 5.0)]
    larger = shard_tree.grown(tree, 3, 2.0)
    keys = spark.range(20000)
    rows = shard_tree.place(shard_tree.place(keys, "id", tree, "old"), "id", larger, "new")
    pairs = Counter(map(tuple, rows.select("old", "new").collect()))
    old, new = Counter(), Counter()
    for (a, b), n in pairs.items():
        assert b in (a, 3)
        old[a] += n
        new[b] += n
    for shard, share in {0: 1 / 8, 1: 2 / 8, 2: 5 / 8}.items():
        assert abs(old[shard] / 20000 - share) < 0.02
    assert abs(new[3] / 20000 - 0.2) < 0.02


def test_hot_missing_and_clashing(spark):
    tree = shard_tree.even_tree(6)
    docs = spark.range(900).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit(1).alias("slot")
    )
    rows = shard_tree.shard_rows(docs, tree, shard_tree.grown(tree, 6)).collect()
    assert len(rows) == 900 and all(r.size == 8 and r.text_crc32 == 0 for r in rows)
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    for shard in range(6):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert shard_tree.shard_rows(docs.limit(0), tree, shard_tree.grown(tree, 6)).count() == 0
