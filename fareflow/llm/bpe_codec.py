"""Byte-level BPE encoding and decoding (operator 4).

Encoding finds the one valid last token of every byte prefix (see ``bpe``, which also has exact appends
and encoding again near edits); the ids are read from the end of each piece. Decoding joins the bytes of
the ids, which gives back any text exactly.

A missing text counts as empty: no ids, no bytes. Ids of documents may be missing or repeat: each row
gets a row. An empty table gives no rows; other columns are not read. There is no shuffle and no state
beyond a bounded cache of pieces, so a lost task is simply run again.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import map_rows
from .token_counts import _quiet_gc


def encode_texts(
    docs: DataFrame, path: str, decoded: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Ids of each text, as ``ids``: little-endian unsigned 32-bit integers one after the other.

    ``decoded`` adds the bytes that these ids stand for, decoded in the same pass.
    """

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        _quiet_gc()
        encoder = bpe.load(path)
        for part in slices:
            ids = encoder.encode_all([text or "" for text in part["text"]])
            out = {id_col: part["id"], "ids": ids}
            yield out | {"decoded": [encoder.decode(x) for x in ids]} if decoded else out

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
        f"`{id_col}` {kind}, ids binary" + ", decoded binary" * decoded,
        rows,
    )


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """The bytes that the ids of each row stand for; a missing ``ids`` counts as none."""

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        encoder = bpe.load(path)
        for part in slices:
            yield {id_col: part["id"], "decoded": [encoder.decode(x or b"") for x in part["ids"]]}

    kind = encoded.schema[id_col].dataType.simpleString()
    return map_rows(encoded.select(F.col(id_col).alias("id"), "ids"), f"`{id_col}` {kind}, decoded binary", rows)
