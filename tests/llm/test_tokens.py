from __future__ import annotations

import base64
import random

import public_tokenizers
import pytest
import tiktoken
from fareflow.llm import bpe, bpe_codec, catalogue, token_counts
from tokenizers import Tokenizer

from .brute import sha256

FOLDER = "/root/testdata/sf0.001"
COUNTS = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RNG = random.Random(7)
TEXTS = [
    "", " ", "\n\n  \t", "a", "don't WE'LL 12345 6", "<|endoftext|> and <|pad|>", "é\U0001f600‍漢字 العربية", "a" * 3000, " " * 500, "ab " * 2000, "\r\n\x00\x7f",
    *["".join(RNG.choice("ab cdE1'\n  é漢.-") for _ in range(RNG.randint(1, 200))) for _ in range(150)],
]


@pytest.fixture(scope="module")
def plain_counts():
    library = Tokenizer.from_file(COUNTS)
    return lambda text: len(library.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def plain_ids():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    library = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: b"".join(i.to_bytes(4, "little") for i in library.encode_ordinary(text))


def texts_of(spark, folder):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}


def test_count_query(spark, plain_counts):
    texts = texts_of(spark, FOLDER)
    rows = catalogue.QUERIES["op2_token_counts"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        n = plain_counts(texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


def test_codec_query(spark, plain_ids):
    texts = texts_of(spark, FOLDER)
    rows = catalogue.QUERIES["op4_bpe_codec"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = plain_ids(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, sha256(ids), sha256(texts[r.doc_id]))


def test_odd_texts(plain_counts, plain_ids):
    counter, encoder = bpe.load(COUNTS), bpe.load(RANKS)
    for text in TEXTS:
        assert counter.count(text) == plain_counts(text)
        assert encoder.encode(text) == plain_ids(text)
        assert encoder.decode(encoder.encode(text)) == text.encode()


@pytest.mark.parametrize("budget", [0, 1, 2, 7, 512])
def test_cuts_are_whole_tokens_within_the_budget(budget):
    library = Tokenizer.from_file(COUNTS)
    counter = bpe.load(COUNTS)
    for text in [*TEXTS, "ab" * 300 + "<|endoftext|>" + "é漢" * 300]:
        n, cut = counter.measure_all([text], budget)[0]
        ids = library.encode(text, add_special_tokens=False).ids
        assert n == len(ids)
        assert cut == sum(len(counter.vocabulary.tokens[i]) for i in ids[:budget])


def test_kept_words_are_bounded_and_batches_equal_single_texts(monkeypatch, plain_ids):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 100_000)
    monkeypatch.setattr(bpe, "TOGETHER", 300)
    encoder = bpe.Encoder(bpe.load(RANKS).vocabulary)
    rng = random.Random(3)
    for _ in range(30):
        texts = [" ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 70))) for _ in range(60)) for _ in range(8)]
        assert encoder.encode_all(texts) == [plain_ids(text) for text in texts]
        assert len(encoder._ids) + len(encoder._old) < 2000


def test_appends_and_edits_give_the_ids_of_the_whole_text(plain_ids):
    rng = random.Random(11)
    kept, text = bpe.Encoding(bpe.load(RANKS)), ""
    for _ in range(80):
        more = rng.choice(TEXTS)[:60]
        if rng.random() < 0.5:
            kept.append(more)
            text += more
        else:
            start = rng.randint(0, len(text))
            end = min(len(text), start + rng.randint(0, 30))
            kept.replace(start, end, more)
            text = text[:start] + more + text[end:]
        assert kept.text == text
        assert kept.ids == plain_ids(text)


def test_missing_texts_repeated_rows_and_other_columns(spark, plain_counts):
    rows = [(1, None, "x", 5), (1, None, "x", 5), (None, "two words", None, None), (3, "word " * 60_000, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    counts = token_counts.count_tokens(docs, COUNTS, 10).collect()
    key = lambda r: (r[0] or 0, *r[1:])
    assert sorted(map(key, counts))[1:3] == [(1, 0, 0, 0), (1, 0, 0, 0)]
    assert {r.doc_id: r.n_tokens for r in counts} == {i: plain_counts(t or "") for i, t, _, _ in rows}
    back = bpe_codec.decode_ids(bpe_codec.encode_texts(docs, RANKS), RANKS).collect()
    assert sorted((r.doc_id or 0, bytes(r.decoded)) for r in back) == sorted((i or 0, (t or "").encode()) for i, t, _, _ in rows)
    for job in (token_counts.count_tokens(docs.limit(0), COUNTS, 10), bpe_codec.encode_texts(docs.limit(0), RANKS)):
        assert job.count() == 0


def test_last_prefix_count_is_the_count_of_the_text(spark, plain_counts):
    docs = spark.createDataFrame(list(enumerate(TEXTS[:40])), "doc_id long, text string")
    found = {}
    for r in token_counts.prefix_counts(docs, COUNTS).collect():
        found.setdefault(r.doc_id, []).append((r.from_byte, r.counts))
    for i, text in enumerate(TEXTS[:40]):
        whole = [n for _, part in sorted(found.get(i, [])) for n in part]
        assert len(whole) == len(text.encode())
        assert (whole[-1] if whole else 0) == plain_counts(text)
