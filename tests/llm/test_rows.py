"""A caller's own columns that are named like those that tell rows apart, odd rows and empty tables, in operators and the pipeline."""

from __future__ import annotations

import pytest
from fareflow.llm import exact_dedup, jaccard_join, mixing, toxicity
from fareflow.llm.common import ROW, row_keys
from pyspark.sql import functions as F

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "one two three four five six seven eight nine ten eleven twelve"
ROWS = [(1, WORDS, "en", "a", 5), (2, WORDS, "en", "a", 5), (3, WORDS + " more", "en", "b", 5), (4, "other words here", None, None, None), (None, None, None, "a", 0)]


def stored(spark, tmp_path, rows, **columns):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns(columns)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(4, 0), (1, 0), (2, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet")


@pytest.mark.parametrize("names", [["__file", "__row"], ["__row"], ["__copies", "__file", "__copy"]])
def test_own_columns_do_not_stand_for_rows(spark, tmp_path, names):
    # Left as they are, these would make all rows one.
    docs = stored(spark, tmp_path, ROWS, **{name: F.lit(7).cast("long") for name in names})
    keyed = row_keys(docs)
    assert keyed.select(*ROW).distinct().count() == len(ROWS)
    assert row_keys(keyed.filter("doc_id > 0")).select(*ROW).distinct().count() == 4
    assert sorted(r.group_size for r in exact_dedup.exact_duplicates(docs).collect()) == [1, 1, 1, 2, 2]
    near = jaccard_join.near_duplicates(docs, n=3, percent=80).collect()
    assert len(near) == len(ROWS) and sum(not r["first"] for r in near) == 2
    assert mixing.mix(docs).count() == len(ROWS)
    assert toxicity.score_texts(docs, toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))).count() == len(ROWS)
    rows = corpus_pipeline.run(spark, str(tmp_path))
    assert rows.columns == ["doc_id", "n_tokens", "ids"]


def test_stages_keep_own_columns(spark, tmp_path):
    docs = stored(spark, tmp_path, ROWS, __row=F.col("doc_id") * 2, keep=F.lit("x"))
    docs, names = corpus_pipeline._aside(docs)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, str(tmp_path)).withColumnsRenamed(names)
        assert kept.columns == [*SCHEMA.replace(" long", "").replace(" string", "").split(", "), "__row", "keep"]
        assert all(r["__row"] == (None if r.doc_id is None else r.doc_id * 2) for r in kept.collect())


@pytest.mark.parametrize("rows", [[], ROWS[4:], [(None, "a b c", None, None, None)] * 4])
def test_pipeline_on_odd_tables(spark, tmp_path, rows):
    stored(spark, tmp_path, rows)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() <= 2 * len(rows)
