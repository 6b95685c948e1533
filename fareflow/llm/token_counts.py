"""Token counts (operator 2): exact numbers of tokens for texts and for all their prefixes.

The prefix dynamic programming of ``bpe`` gives the number of tokens of every prefix of a piece, and
pieces do not reach into each other, so counts of whole texts, of prefixes and cuts at a budget all come
from one walk and nothing is encoded again.

A missing text counts as empty and has no tokens. Ids may be missing or repeat: each row gets a row.
An empty table gives no rows; other columns are not read. Work is done row by row in constant memory for
all but the text itself, with no shuffle, so a lost task is simply run again.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import map_rows

# Entries in one row of prefix_counts.
CHUNK = 1 << 16


def _quiet_gc() -> None:
    """The kept pieces have no cycles; looking for some after every few hundred new ones costs a third of the time."""
    gc.set_threshold(1_000_000)
    gc.freeze()


def count_tokens(docs: DataFrame, path: str, budget: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of each text, and the bytes of its longest start of whole tokens within ``budget``.

    ``path`` names a vocabulary file that every executor has. Special strings in a text count as one token
    if the file lists them. Columns: the id, ``n_bytes``, ``n_tokens``, ``cut_bytes``.
    """

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        _quiet_gc()
        encoder = bpe.load(path)
        for part in slices:
            texts = [text or "" for text in part["text"]]
            sizes = [len(text.encode()) for text in texts]
            measured = encoder.measure_all(texts, budget)
            counts, cuts = [n for n, _ in measured], [cut for _, cut in measured]
            yield {id_col: part["id"], "n_bytes": sizes, "n_tokens": counts, "cut_bytes": cuts}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
        f"`{id_col}` {kind}, n_bytes long, n_tokens long, cut_bytes long",
        rows,
    )


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The number of tokens of every prefix of every text, by the pieces of that text.

    A row holds the counts for the prefixes that end at bytes ``from_byte + 1``, ``from_byte + 2`` and so on;
    long texts take several rows. Empty and missing texts take none.
    """

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        _quiet_gc()
        encoder = bpe.load(path)
        for part in slices:
            for name, text in zip(part["id"], part["text"], strict=True):
                start, held = 0, []
                for _, counts in encoder.prefix_counts(text or ""):
                    held += counts
                    while len(held) >= CHUNK:
                        yield {id_col: [name], "from_byte": [start], "counts": [held[:CHUNK]]}
                        start, held = start + CHUNK, held[CHUNK:]
                if held:
                    yield {id_col: [name], "from_byte": [start], "counts": [held]}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
        f"`{id_col}` {kind}, from_byte long, counts array<int>",
        rows,
    )
