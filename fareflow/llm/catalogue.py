"""The operators as queries over whole tables, with the parameters they are meant to run with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from . import exact_dedup, jaccard_join, line_dedup, merkle, mixing, pii, shard_tree, toxicity, vector_graph, warc, word_runs
from .bpe_codec import encode_texts
from .common import table
from .token_counts import count_tokens

TOKEN_LIMIT = 512


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_pii(table(spark, folder, "documents"))
    count = lambda kind: F.size(pii.of_kinds(F.col("spans"), kind)).cast("long").alias(f"n_{kind}")
    base = pii.written(pii.of_kinds(F.col("spans"), *pii.BASE))
    return found.select(
        "doc_id", *[count(kind) for kind in pii.BASE], F.sha2(base, 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans")
    )


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    counts = count_tokens(table(spark, folder, "documents"), path, TOKEN_LIMIT)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "cut_bytes")


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = jaccard_join.near_duplicates(table(spark, folder, "documents"), n=3, percent=90)
    return rows.select("doc_id", "n_shingles", "component_id")


def op4_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode_texts(table(spark, folder, "documents"), path, decoded=True)
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = toxicity.score_texts(docs, toxicity.fit(docs, table(spark, folder, "labels")))
    predicted = (F.col("score") >= 0.5).cast("int")
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", predicted.alias("predicted"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = exact_dedup.exact_duplicates(table(spark, folder, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.mix(table(spark, folder, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", taken, "copies")


def op8_vector_graph(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    index = vector_graph.build_index(vectors, k=20)
    return vector_graph.search(index, vectors.filter("vec_id % 20 = 0"), k=20)


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark)}/archives"
    chunks = warc.chunk_records(table(spark, folder, "pages"))
    warc.write_archives(chunks, warc.record_types(chunks), path)
    return warc.read_archives(spark, path)


def op10_shard_tree(spark: SparkSession, folder: str) -> DataFrame:
    tree = shard_tree.even_tree(24)
    placed = shard_tree.shard_rows(table(spark, folder, "documents"), tree, shard_tree.grown(tree, 24))
    return placed.withColumn("law", F.lit("key")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fields = lambda text: [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")] + [text]
    # Tampered rows lose their line feeds.
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = F.unhex(merkle.row_digest(fields(F.replace("text", F.lit("\n"), F.lit("")))))
    rows = docs.select(
        merkle.group_key(F.col("source")).alias("key"),
        "doc_id",
        F.unhex(merkle.row_digest(fields(F.col("text")))).alias("digest"),
        F.when(tampered, changed).alias("tampered"),
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    manifest = merkle.build_manifest(rows, ["doc_id"], {"doc_id": kind, "tampered": "binary"})
    root = F.lit(manifest.root).cast("string")
    return merkle.prove(manifest, "doc_id", kind, "tampered").select(
        "doc_id", "leaf", "subroot", root.alias("root"), F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def _planted(docs: DataFrame) -> Column:
    """The texts, where every tenth by checksum of its id repeats a stretch of its words to the end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(held: Column) -> Column:
        n = F.size(held)
        begin = g % n
        period = 1 + F.floor((n - begin) / (3 + g % 8))
        at = lambda i: F.get(held, F.when(i < begin, i).otherwise(begin + (i - begin) % period).cast("int"))
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), at), " ")

    # The words are a variable of the lambda, so that they are cut once for a text.
    planted = F.transform(F.array(words), lambda held: F.when(F.size(held) > 0, repeated(held)).otherwise(""))[0]
    return F.when(h % 10 == 0, planted).otherwise(F.col("text"))


def op12_word_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = word_runs.find_runs(docs.select("doc_id", _planted(docs).alias("text")))
    # Exponents are compared as fractions, so that no rounding makes or breaks a tie.
    order = """(a, b) -> CASE
        WHEN a.length * b.period <> b.length * a.period THEN CAST(sign(b.length * a.period - a.length * b.period) AS INT)
        WHEN a.start <> b.start THEN CAST(sign(a.start - b.start) AS INT)
        ELSE CAST(sign(a.period - b.period) AS INT) END"""
    written = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", F.get(F.expr(f"array_sort(runs, {order})"), F.lit(0)))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(written, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_dedup.dedup_lines(table(spark, folder, "documents"), min_chars=20, min_docs=3)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_token_counts": op2_token_counts,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_bpe_codec": op4_bpe_codec,
    "op5_toxicity": op5_toxicity,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_mixing": op7_mixing,
    "op8_vector_graph": op8_vector_graph,
    "op9_warc": op9_warc,
    "op10_shard_tree": op10_shard_tree,
    "op11_merkle": op11_merkle,
    "op12_word_runs": op12_word_runs,
    "op13_line_dedup": op13_line_dedup,
}

ORACLES: dict[str, str] = {
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op13_line_dedup": r"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        lines AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM docs),
        keyed AS (
            SELECT *, translate(trim(line, E' \t\n\x0B\f\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ),
        shared AS (
            SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3
        ),
        marked AS (
            SELECT r, keyed.doc_id, line, place, (shared.key IS NOT NULL AND keyed.doc_id IS DISTINCT FROM top) AS dropped
            FROM keyed LEFT JOIN shared ON keyed.key = shared.key
        )
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY r
    """,
}
