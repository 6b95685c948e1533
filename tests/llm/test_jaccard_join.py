from __future__ import annotations

import random
import re

import pytest

from fareflow.llm import catalogue, jaccard_join
from fareflow.llm.components import components
from pyspark.sql import functions as F


def plain(texts: dict, n: int, percent: int) -> dict:
    """Every pair compared, by the words themselves."""
    sets = {}
    for i, text in texts.items():
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        width = min(n, len(words))
        sets[i] = {tuple(words[j : j + width]) for j in range(len(words) - width + 1)} if words else set()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for at, a in enumerate(ids):
        for b in ids[:at]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in texts}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
    return " ".join(words)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_groups_of_edited_copies(spark, n, percent):
    rng = random.Random(n)
    texts = [None, "", " \t", "one", "One", "one two", "ONE two\n", "é É", "É É"]
    for group in range(8):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([12, 60, 150]))]
        texts += [edited(rng, words, rng.randrange(0, 9)) for _ in range(30)]
        # A chain: each text is near to the one before it, the ends are not near to each other.
        for _ in range(10):
            words = edited(rng, words, 1).split(" ")
            texts.append(" ".join(words))
    common = " ".join(f"p{i}" for i in range(60))
    texts += [f"{common} {' '.join(f'u{rng.randrange(10**9)}' for _ in range(k))}" for k in range(0, 40)]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = jaccard_join.near_duplicates(docs, n, percent).collect()
    expected = plain(dict(enumerate(texts)), n, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    firsts = [r.component_id for r in rows if r.first]
    assert sorted(firsts) == sorted({c for _, c in expected.values()})


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    rows = catalogue.QUERIES["op3_jaccard_join"](spark, folder).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain(texts, 3, 90)


def test_missing_and_repeated_ids_and_clashing_columns(spark):
    rows = [(None, "a b c d", 1), (4, "a b c d", 2), (4, "a b c d", 2), (None, "x", 3), (5, None, 4), (6, "", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sid int").withColumns({"n": F.lit(1), "label": F.lit(2)})
    found = jaccard_join.near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in found) == [
        (0, 1, 0), (0, 1, 4), (4, 1, 4), (4, 1, 4), (5, 0, 5), (6, 0, 6),
    ]
    assert jaccard_join.near_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200, 203), (203, 201), (7, 7)]
    rng.shuffle(links)
    found = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200, 203: 200}
