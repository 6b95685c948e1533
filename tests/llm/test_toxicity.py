from __future__ import annotations

import random
import zlib

import numpy as np
from fareflow.llm import catalogue, toxicity
from pyspark.sql import functions as F


def test_query_on_labels_it_has_not_seen(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = catalogue.QUERIES["op5_toxicity"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    pairs = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    true = sum(a == b == 1 for a, b in pairs)
    # Some toxic labels in this table belong to texts without any toxic word.
    assert true / sum(a for a, _ in pairs) >= 0.85
    assert true / sum(b for _, b in pairs) >= 0.95


def _texts(rng, n):
    """Toxic texts name one group more often; the insult alone decides."""
    rows = []
    for i in range(n):
        toxic = i % 3 == 0
        named = rng.random() < (0.8 if toxic else 0.1)
        words = [f"w{rng.randrange(60)}" for _ in range(20)] + ["muslims"] * named + ["vileword"] * (toxic and rng.random() < 0.8)
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_swapped_mentions_hardly_change_a_score(spark):
    rows = _texts(random.Random(1), 900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    gaps = []
    for penalty in (0.0, 20.0):
        model = toxicity.fit(docs, labels, penalty=penalty)
        a, b = model.score(["w1 w2 muslims w3", "w1 w2 christians w3"])
        gaps.append(abs(a - b))
        assert model.score(["w1 vileword w3"])[0] > 0.5
    assert gaps[1] < 0.1 < gaps[0]


def test_no_labels_odd_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(None, None, 1.0), (1, "", 2.0), (1, "x " * 50000, 2.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int").withColumn("text", F.lit("z"))
    model = toxicity.fit(docs, labels)
    scores = [r.score for r in toxicity.score_texts(docs, model).collect()]
    assert len(scores) == 3 and np.allclose(scores, 0.0)
    assert toxicity.score_texts(docs.limit(0), model).count() == 0


def test_one_id_in_many_rows_is_one_text_to_learn_from(spark):
    rows = [(1, f"text {i}") for i in range(500)] + [(i, "vileword") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)] * 3, "doc_id long, toxic int")
    learnt = toxicity._labelled(docs, labels, "doc_id", "text", 20).collect()
    assert len(learnt) == 20


def test_labels_of_one_kind_are_no_ground_to_reject(spark, tmp_path):
    import corpus_pipeline

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert not toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet")).fitted
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == 20
