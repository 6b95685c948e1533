from __future__ import annotations

import random

import pytest

from fareflow.llm import catalogue, pii
from pyspark.sql import functions as F

from .brute import base_spans, sha256

TEXTS = [
    None,
    "",
    "write to a.b+c@mail.example.com_d@e.f or @x.y, a@b, a@b..c, x@y.z.",
    "1.2.3.4.5.6.7.8 and 256.1.1.1 then 0001.2.3.255, 1.2.3",
    "4348649190265535 4348 6491-9026 5535 43486491902655351 12 34 4348649190265536",
    "++1 (988) 555-2485, +1234567, +49 30 1234567-8901234567, +1--2 +5 (",
    "\U0001f600 café a@b.co ü +1 (988) 555-2485 10.0.0.1",
    "Account GB82 WEST 1234 5698 7654 32, not GB82 WEST 1234 5698 7654 33",
    "card 378282246310005 but number 378282246310005",
    "my social security number is 078-05-1120; part 078-05-1120x",
    "a@b.c" * 400 + " 9" * 30000,
    "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
    "4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1 and 4 1-1 1-1 1-1 1-1 1-1 1-1 1-1 1",
    ".".join(["1"] * 5000) + "@" + ".".join(["a"] * 20000),
]


def test_base_spans_equal_the_plain_search(spark):
    rng = random.Random(5)
    noise = ["".join(rng.choice("019 .-+()@ab%_\né") for _ in range(rng.randint(0, 300))) for _ in range(600)]
    cards = ["".join(rng.choice(["4348", "6491", " ", "-", "90265535", "4111111111111111", "x"]) for _ in range(8)) for _ in range(300)]
    rows = list(enumerate(TEXTS + noise + cards))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.find_pii(docs).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        ours = [(s.kind, s.start, s.end) for s in found[i] if s.kind in pii.BASE]
        assert ours == base_spans(text), repr(text)[:200]


def test_checksums_and_words_nearby_decide_on_added_kinds(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = {r.doc_id: [(s.kind, TEXTS[r.doc_id][s.start : s.end]) for s in r.spans if s.kind not in pii.BASE] for r in pii.find_pii(docs).collect()}
    assert found[7] == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert found[8] == [("shortcard", "378282246310005")] * 2 or found[8] == [("shortcard", "378282246310005")]
    assert found[9][0] == ("ssn", "078-05-1120")
    assert found[0] == found[1] == []


def test_null_ids_repeated_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(None, "a@b.co", 1), (3, "a@b.co", 2), (3, "a@b.co", 2)], "doc_id long, text string, spans int"
    ).withColumns({"email": F.lit("x"), "__text": F.lit("y")})
    rows = pii.find_pii(docs).collect()
    assert [len(r.spans) for r in rows] == [1, 1, 1]
    assert pii.find_pii(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["sf0.001"])
def test_query(spark, name):
    folder = f"/root/testdata/{name}"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    rows = catalogue.QUERIES["op1_pii"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = base_spans(texts[r.doc_id])
        assert r.base_sha256 == sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pii.BASE]
