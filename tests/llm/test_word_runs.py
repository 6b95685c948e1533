from __future__ import annotations

import random
import re
from zlib import crc32

import numpy as np
from fareflow.llm import catalogue, word_runs
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from .brute import sha256


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_runs(words, least_words=6, least=4):
    """Every period, every stretch."""
    n, found = len(words), {}
    for p in range(1, n // least + 1):
        s = 0
        while s + p < n:
            e = s
            while e + p < n and words[e] == words[e + p]:
                e += 1
            length = e - s + p
            if e > s and length >= max(least_words, least * p):
                found.setdefault((s, length), p)
            s = e + 1
    return sorted((s, length, p) for (s, length), p in found.items())


def collapsed(words, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found(spark, texts, parts=3):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("id", F.lit("x"))
    rows = word_runs.find_runs(docs.repartition(parts)).collect()
    return {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed, r.n_words) for r in rows}


def check(spark, texts):
    got = found(spark, texts)
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = words_of(text)
        runs = plain_runs(words)
        assert [(s, n, p) for s, n, p in got[i][0]] == [(s, n, p) for s, n, p in sorted(runs, key=lambda r: (r[0], r[2]))], text
        assert got[i][1:] == (collapsed(words, runs), len(words))


def repetitive(rng):
    out = []
    for _ in range(rng.randint(0, 12)):
        unit = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        out += unit * rng.randint(1, 9) + unit[: rng.randint(0, len(unit))]
        out += [rng.choice("abcdef") for _ in range(rng.randint(0, 3))]
    return rng.choice((" ", "\n", "\x0b ")).join(out)


def test_against_all_stretches(spark):
    rng = random.Random(5)
    texts = [repetitive(rng) for _ in range(600)]
    texts += [None, "", " \n\t", "a", "a a a a", "a a a a a", "a a a a a a", "ab ab ab ab AB ab", "a a " * 9, "x " * 5000]
    texts += ["a b " * 700 + "a c " * 700, "a b c d e " * 3 + "a b c d", "a b c d e " * 4, "á é " * 20]
    check(spark, texts)


def test_grid_words_that_agree_without_a_run(spark):
    rng = random.Random(6)
    # The same word at every other place, others all different or of two kinds.
    texts = [" ".join(f"the w{i}" for i in range(800)), " ".join(f"the {rng.choice('ab')}" for _ in range(800))]
    texts += ["the x y " * 30 + " ".join(f"the z{i} y" for i in range(300)) + " the x y" * 30]
    check(spark, texts)


def test_nested_and_neighbouring_runs(spark):
    inner = "a a a a a a b " * 6
    check(spark, [inner, inner * 2 + "c " + inner, ("x y " * 4 + "z ") * 5, "a " * 9 + "b " * 9 + ("a " * 9 + "b " * 9) * 5])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120), st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(0, 30))
def test_runs_of_one_sequence(head, unit, times):
    words = head + unit * times + head[:5]
    held = np.array([-1, *words, -2], np.int64)
    text = np.array([0, *[1] * len(words), 2])
    runs = word_runs.runs_of(held, text, len(words), 4)
    assert sorted((s - 1, e - s, p) for (s, e), p in runs.items() if e - s >= 6) == plain_runs(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=200), st.randoms())
def test_common_extensions(words, rng):
    held = np.array([-1, *words, -2], np.int64)
    grammar = word_runs.Grammar(held)
    mirror = grammar.mirrored()
    pairs = [(rng.randrange(len(held)), rng.randrange(len(held))) for _ in range(40)]
    pairs = [(a, b) for a, b in pairs if a != b]
    a, b = np.array([x for x, _ in pairs]), np.array([x for _, x in pairs])
    for g, seq in ((grammar, held), (mirror, held[::-1])):
        for x, y, n in zip(a, b, g.common(a, b), strict=True):
            k = 0
            while max(x, y) + k < len(seq) and seq[x + k] == seq[y + k]:
                k += 1
            assert n == k


def test_query(spark, tmp_path):
    rng = random.Random(7)
    texts = [repetitive(rng) if i % 2 else " ".join(f"w{rng.randrange(500)}" for _ in range(rng.randint(0, 300))) for i in range(300)]
    rows = [*enumerate(texts), (1000, None), (1001, ""), (None, "a " * 20), (1002, " a  b\n")]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in catalogue.QUERIES["op12_word_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    planted = 0
    for i, text in rows:
        words = words_of(text)
        n, h = len(words), crc32(str(i).encode())
        g = h // 10
        if i is not None and h % 10 == 0 and n:
            a, planted = g % n, planted + 1
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if j < a else words[a + (j - a) % p] for j, w in enumerate(words)]
        runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs))
        assert r.collapsed_sha256 == sha256(collapsed(words, runs))
    assert planted > 10
    assert catalogue.QUERIES["op12_word_runs"](spark, str(tmp_path)).filter("doc_id < 0").count() == 0
