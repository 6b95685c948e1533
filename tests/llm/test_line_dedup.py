from __future__ import annotations

import random
from collections import defaultdict

from fareflow.llm import line_dedup
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITE = " \t\n\x0b\x0c\r"
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(rows, min_chars=20, min_docs=3):
    """Per row: lines before, lines dropped, text."""
    held = defaultdict(set)
    for place, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            key = line.strip(WHITE).translate(LOWER)
            if len(key) >= min_chars:
                held[key].add(place)
    rank = lambda i: (i is not None, i or 0)
    top = {key: max((rows[place][0] for place in places), key=rank) for key, places in held.items() if len(places) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if (key := x.strip(WHITE).translate(LOWER)) not in top or top[key] == i]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def found(docs, **options):
    rows = line_dedup.dedup_lines(docs, **options).collect()
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in rows), key=str)


def stored_lines(docs):
    return line_dedup.line_table(line_dedup.row_keys(docs).select(*line_dedup.ROW, F.col("doc_id").alias("id"), "text"), 20)


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def test_random_lines(spark):
    rng = random.Random(4)
    pool = [f"{'Passage' if i % 3 else 'PASSAGE ÄÖ'} number {i // 2} of the lot" for i in range(60)] + ["", "short", "x" * 19, "é" * 20, "  \t"]
    rows = []
    for i in range(300):
        lines = [rng.choice(pool) for _ in range(rng.choice((0, 1, 3, 200)))]
        lines = [rng.choice(("", "  ", "\t")) + (x.upper() if rng.random() < 0.3 and x.isascii() else x) + rng.choice(("", "\r", " ")) for x in lines]
        rows.append((i, "\n".join(lines)))
    rows += [(900, None), (901, ""), (902, "\n"), (903, "\n\n"), (None, pool[0] + "\n" + pool[1]), (905, " " + "nbsp stays in the key of it")]
    assert found(frame(spark, rows)) == plain(rows)


def test_repeated_ids_and_all_lines_dropped(spark):
    line = "the same long line in all of them"
    rows = [(1, line), (1, line), (2, f"{line}\n{line}"), (2, f"a\n{line}\nb"), (None, line), (None, None)]
    assert found(frame(spark, rows)) == plain(rows)
    # Copies within one document are no other documents.
    rows = [(1, "\n".join([line] * 9)), (2, line)]
    assert found(frame(spark, rows)) == plain(rows) == [(1, 9, 0, rows[0][1]), (2, 1, 0, line)]
    # Where no holder has an id, none is below the others.
    rows = [(None, line)] * 4
    assert found(frame(spark, rows)) == plain(rows)


def test_a_line_in_most_rows_spans_partitions(spark, tmp_path):
    line = "a licence line that very many documents share"
    rows = [(i, f"{line}\nown text number {i} of this table\n{line}") for i in range(4000)]
    path = str(tmp_path / "docs")
    frame(spark, rows, 8).withColumns({"h1": F.lit(1), "__row": F.lit(0), "part": F.lit("x"), "line": F.lit("y")}).write.parquet(path)
    docs = spark.read.parquet(path)
    # So few rows would be put together in one partition.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(docs) == plain(rows)
        lines = stored_lines(docs)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = lines.groupBy("h1", "h2").agg(F.countDistinct("part").alias("parts"), F.count("*").alias("n")).filter("n = 8000").first()
    assert hot.parts > 1


def test_bitmaps_are_sparse(spark):
    line = "this line is in each of the documents"
    rows = [(i, "\n".join(f"line {j} of document {i}, which is long" if j != 700 else line for j in range(1000))) for i in range(3)]
    docs = frame(spark, rows)
    bitmaps = line_dedup.keep_bitmaps(docs).collect()
    assert len(bitmaps) == 2
    assert all([w.word for w in b.bitmap] == [10] and b.n_dropped == 1 for b in bitmaps)
    assert found(docs) == plain(rows)


def test_empty_table_and_parameters(spark):
    schema = T.StructType().add("doc_id", T.LongType()).add("text", T.StringType())
    assert found(spark.createDataFrame([], schema)) == []
    rows = [(i, "ab\nabc\nx") for i in range(2)]
    assert found(frame(spark, rows), min_chars=2, min_docs=2) == plain(rows, 2, 2) == [(0, 3, 2, "x"), (1, 3, 0, "ab\nabc\nx")]


def test_built_in_functions_only(spark, data):
    from fareflow.llm import catalogue

    plan = catalogue.QUERIES["op13_line_dedup"](spark, data)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "Pandas" not in plan
