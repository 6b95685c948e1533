from __future__ import annotations

import base64
import gzip
import hashlib
from collections import defaultdict

from fareflow.llm import catalogue, warc


def check(rows, pages: dict):
    groups = defaultdict(list)
    for i, html in pages.items():
        groups[html or ""].append(i)
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        data = (pages[r.page_id] or "").encode()
        response = max(groups[pages[r.page_id] or ""])
        assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert r.record_type == ("response" if r.page_id == response else "revisit")
        assert r.refers_to == (None if r.page_id == response else response)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html").collect()}
    check(catalogue.QUERIES["op9_warc"](spark, folder).collect(), pages)


def test_segments_line_ends_and_records_inside_payloads(spark, tmp_path):
    texts = [
        None, "", "\n", "\r\n", "\r\n\r\n", "a\r", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "é\U0001f600" * 40,
        "x" * 100, "line\n" * 60, "x" * 100, "\r\n" * 31, None,
    ]
    pages = spark.createDataFrame([(i, f"http://h/{i} a\r\nX: y", t, "z") for i, t in enumerate(texts)], "page_id long, url string, html string, chunk string")
    chunks = warc.chunk_records(pages, chunk_chars=16)
    last = {r.page_id: r for r in chunks.filter("last").collect()}
    assert last[7].chunk == 4 and last[7].bytes_to == len(texts[7].encode())
    path = str(tmp_path / "archives")
    warc.write_archives(chunks, warc.record_types(chunks), path)
    check(warc.read_archives(spark, path).collect(), dict(enumerate(texts)))
    files = [gzip.open(f).read() for f in (tmp_path / "archives").glob("*.gz")]
    assert any(f.startswith(b"WARC/1.1\r\n") for f in files)
    assert sum(f.count(b"WARC-Type: continuation") for f in files) > 20


def test_least_size_and_odd_ids(spark, tmp_path):
    rows = [(None, "u", "aa"), (1, None, "aa"), (1, None, "aa"), (2, "u", "b"), (3, "u", "b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    chunks = warc.chunk_records(pages)
    path = str(tmp_path / "archives")
    warc.write_archives(chunks, warc.record_types(chunks, min_bytes=2), path)
    found = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in warc.read_archives(spark, path).collect())
    assert found == [(0, "revisit", 1), (1, "response", None), (1, "revisit", 1), (2, "response", None), (3, "response", None)]
    empty = str(tmp_path / "empty")
    chunks = warc.chunk_records(pages.limit(0))
    warc.write_archives(chunks, warc.record_types(chunks), empty)
    assert warc.read_archives(spark, empty).count() == 0
