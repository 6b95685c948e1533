"""Web archives (operator 9) by way of a chunked record table.

Payloads travel as rows of record and chunk number, each with the bytes and the SHA-1 of all that came up to and
with it, so that no step needs a whole payload of an oversized record. Chunks become the segments of a WARC 1.1
record: the first one carries the record's own type, the others are continuations. Reading goes through the files
line by line, by their content lengths, and computes the digests anew.

Of records with equal payloads (by digest and length) of at least ``min_bytes``, the one with the largest page id is
a response and the others are revisits without a payload; a missing id is below all others, and of rows that tie
the one that is last in its table is the response. Smaller payloads are all responses. A missing payload counts as
empty. Ids may be missing or repeat, and the same page may come twice: each row gets a record of its own. An empty
table gives no records; other columns are not read. Files are unsplittable by their compression, so that each is
read from its start.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, map_rows, row_keys

ROW = ["__file", "__row"]
CHUNK_CHARS = 1 << 18
DATE = "2024-01-01T00:00:00Z"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunk_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """Rows of record and chunk number: ``payload``, its place, and bytes and digest of all up to its end.

    Columns: ``__file``, ``__row``, the id, ``url``, ``chunk``, ``last``, ``payload``, ``bytes_to``, ``digest_to``.
    Chunks end between characters. An empty payload has one empty chunk.
    """
    pages = row_keys(pages).select(*ROW, F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(text_col).alias("text"))

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        for part in slices:
            for file, row, name, url, text in zip(*(part[c] for c in (*ROW, "id", "url", "text")), strict=True):
                text, total, running = text or "", 0, hashlib.sha1()
                for chunk, begin in enumerate(range(0, len(text), chunk_chars) or (0,)):
                    payload = text[begin : begin + chunk_chars]
                    data = payload.encode()
                    running.update(data)
                    total += len(data)
                    yield {
                        "__file": [file], "__row": [row], id_col: [name], "url": [url], "chunk": [chunk],
                        "last": [begin + chunk_chars >= len(text)], "payload": [payload], "bytes_to": [total],
                        "digest_to": [_base32(running.digest())],
                    }

    def gathered(slices: Iterator[dict]) -> Iterator[dict]:
        """Join one-chunk rows to batches of some megabytes."""
        held: dict[str, list] = {}
        size = 0
        for row in rows(slices):
            for column, values in row.items():
                held.setdefault(column, []).extend(values)
            size += len(row["payload"][0])
            if size > 4 * CHUNK_CHARS or len(held["chunk"]) >= 1000:
                yield held
                held, size = {}, 0
        if held:
            yield held

    kind = pages.schema["id"].dataType.simpleString()
    return map_rows(
        pages,
        f"__file long, __row long, `{id_col}` {kind}, url string, chunk int, last boolean, payload string, "
        "bytes_to long, digest_to string",
        gathered,
    )


def record_types(chunks: DataFrame, min_bytes: int = 0, id_col: str = "page_id") -> DataFrame:
    """Per record: its place, ``bytes``, ``digest``, and for revisits ``refers_row`` with place and id of the response."""
    whole = chunks.filter("last").select(*ROW, id_col, F.col("bytes_to").alias("bytes"), F.col("digest_to").alias("digest"))
    whole = checkpointed(whole)
    same = ["digest", "bytes"]
    groups = whole.filter(F.col("bytes") >= min_bytes).groupBy(*same).agg(F.max(F.struct(id_col, *ROW)).alias("response"))
    # Kept apart from the join, so that the join may split a payload that very many pages share.
    rows = whole.join(checkpointed(groups), same, "left")
    own = (F.col("response.__file") == F.col("__file")) & (F.col("response.__row") == F.col("__row"))
    return rows.select(*ROW, *same, F.when(~own, F.col("response")).alias("refers_row"))


def _uuid(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws("/", *[p.cast("string") for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; none if there is no value."""
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")))


def write_archives(chunks: DataFrame, types: DataFrame, path: str, id_col: str = "page_id") -> None:
    """Write all records below ``path``, one gzip file for each task."""
    rows = chunks.join(types, ROW)
    revisit = F.col("refers_row").isNotNull()
    first = F.col("chunk") == 0
    # A revisit has no payload; its later chunks have nothing to say.
    rows = rows.filter(first | ~revisit).sortWithinPartitions(*ROW, "chunk")
    segmented = ~revisit & ~(first & F.col("last"))
    record = _uuid(*map(F.col, ROW), F.lit(0))
    url = F.regexp_replace(F.coalesce("url", F.concat(F.lit("urn:page:"), F.col(id_col).cast("string")), F.lit("urn:page")), "[\\x00-\\x20\\x7f]", "%20")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n")
    )
    block = F.when(revisit, "").otherwise(F.concat(F.when(first, http).otherwise(""), "payload"))
    rows = rows.withColumn("__block", block)
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").when(first, "response").otherwise("continuation"),
        F.lit("\r\n"),
        _line("WARC-Record-ID", _uuid(*map(F.col, ROW), F.col("chunk"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _line("Content-Type", F.when(first, "application/http; msgtype=response")),
        _line("WARC-Segment-Number", F.when(segmented, F.col("chunk") + 1)),
        _line("WARC-Segment-Origin-ID", F.when(~first, record)),
        _line("WARC-Segment-Total-Length", F.when(segmented & F.col("last"), F.col("bytes") + F.octet_length(http))),
        _line("WARC-Refers-To", F.when(revisit, _uuid(F.col("refers_row.__file"), F.col("refers_row.__row"), F.lit(0)))),
        _line("X-Page-Id", F.col(id_col)),
        _line("X-Refers-To-Page-Id", F.col(f"refers_row.{id_col}")),
        _line("X-Payload-Length", F.col("bytes")),
        _line("Content-Length", F.octet_length("__block")),
        F.lit("\r\n"),
    )
    # Two line ends close a record; the writer adds the second.
    rows.select(F.concat(header, "__block", F.lit("\r\n")).alias("value")).write.option("lineSep", "\r\n").text(path, compression="gzip")


class _Reader:
    """Takes the lines of a file in turn and gives a row for each whole record."""

    def __init__(self) -> None:
        self.state, self.head, self.left, self.http = "between", {}, 0, False
        self.record: dict[str, str] = {}
        self.sha, self.size = hashlib.sha1(), 0

    def line(self, text: str) -> tuple | None:
        if self.state == "body" and self.left:
            return self._body(text)
        if self.state == "head":
            if text != "\r":
                name, _, value = text.rstrip("\r").partition(": ")
                self.head[name] = value
                return None
            return self._begin()
        if text.startswith("WARC/"):
            self.state, self.head = "head", {}
        elif text not in ("\r", ""):
            raise ValueError(f"no record begins here: {text[:60]!r}")
        return None

    def _begin(self) -> tuple | None:
        self.state, self.left = "body", int(self.head["Content-Length"])
        kind = self.head["WARC-Type"]
        if kind == "continuation":
            if self.head["WARC-Segment-Origin-ID"] != self.record.get("WARC-Record-ID"):
                raise ValueError("a segment without the one before it")
        else:
            self.record, self.sha, self.size = self.head, hashlib.sha1(), 0
            self.http = kind == "response"
        return None if self.left else self._end()

    def _body(self, text: str) -> tuple | None:
        data = text.encode() + b"\n"
        data = data[: self.left]
        self.left -= len(data)
        if self.http:
            self.http = data != b"\r\n"
        else:
            self.sha.update(data)
            self.size += len(data)
        return None if self.left else self._end()

    def _end(self) -> tuple | None:
        self.state = "between"
        if "WARC-Segment-Number" in self.head and "WARC-Segment-Total-Length" not in self.head:
            return None
        record, number = self.record, lambda name: int(self.record[name]) if name in self.record else None
        digest = record["WARC-Payload-Digest"].removeprefix("sha1:")
        if record["WARC-Type"] == "response" and (_base32(self.sha.digest()), self.size) != (digest, number("X-Payload-Length")):
            raise ValueError(f"the payload of {record['WARC-Record-ID']} is not the one that was written")
        return number("X-Page-Id"), number("X-Payload-Length"), digest, record["WARC-Type"], number("X-Refers-To-Page-Id")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Per record: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``.

    Payloads are digested on the way and compared with their headers; one that differs stops the job.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, file = _Reader(), None
        for part in parts:
            found = []
            for text, name in zip(part.column("value").to_pylist(), part.column("file").to_pylist(), strict=True):
                if name != file:
                    reader, file = _Reader(), name
                row = reader.line(text)
                if row is not None:
                    found.append(row)
            columns = list(zip(*found, strict=True)) or [()] * len(names)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.xxhash64("_metadata.file_path").alias("file"))
    return lines.mapInArrow(batches, schema)
