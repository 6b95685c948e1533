"""A corpus from raw documents to tokens, in five stages.

Each stage works on all rows that the one before it kept: toxic documents go, of equal texts one stays, of near
copies (five words, similarity of 0.8 or more) one stays, sources are mixed to their target weights, which repeats
some documents and leaves out others, and what is left is encoded. Rows are told apart by their place in the
stored table, so ids may be missing or repeat.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm import bpe_codec, exact_dedup, jaccard_join, mixing, toxicity
from fareflow.llm.common import checkpointed, restrict, row_keys, table
from fareflow.session import shared_folder

ROW = ["__file", "__row"]


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The documents without some rows, in their own columns."""
    return restrict(row_keys(docs), checkpointed(rows.select(*ROW)), ROW, keep=False).drop(*ROW)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without labels of both kinds nothing can be learnt, and all documents stay."""
    docs = row_keys(docs)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    if not model.fitted:
        return docs.drop(*ROW)
    return _without(docs, toxicity.score_texts(docs, model).filter("score >= 0.5"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = row_keys(docs)
    return _without(docs, exact_dedup.exact_duplicates(docs).filter("not kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = row_keys(docs)
    return _without(docs, jaccard_join.near_duplicates(docs, n=5, percent=80).filter("not first"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = row_keys(docs)
    taken = checkpointed(mixing.mix(docs).filter("copies > 0").select(*ROW, F.col("copies").cast("int").alias("__copies")))
    rows = restrict(docs, taken, ROW, keep=True)
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).drop(*ROW, "__copies", "__copy")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document taken, with its ids as little-endian unsigned 32-bit integers."""
    ids = bpe_codec.encode_texts(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return ids.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]

# The classifier, the links of near copies and the encoding have no SQL; tests compare with plain versions.
ORACLE_SQL = None


def _aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Columns of the caller's own whose names the stages use themselves get others meanwhile."""
    others = {name: f"own_{place}_{name}" for place, name in enumerate(docs.columns) if name.startswith("__")}
    return docs.withColumnsRenamed(others), {other: name for name, other in others.items()}


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage gives is stored before the next one reads it."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark)
    for place, (_, stage) in enumerate(STAGES):
        path = f"{folder}/stage-{place}"
        docs, names = _aside(docs)
        stage(spark, docs, sf_dir).withColumnsRenamed(names).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
