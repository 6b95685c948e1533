"""Exact duplicates (operator 6) by deterministic block naming.

Each text is cut into blocks of a fixed number of bytes. Equal blocks get the same integer name, different
blocks different ones: blocks are dealt by their content, sorted, and numbered in that order. Then adjacent pairs of
names are named in the same way, level by level, until each text has one name. Two texts are equal if and
only if they have the same number of blocks and the same name; no hash decides about it.

Only blocks that a partition has not sent before travel to be named, each with a ticket, and tickets bring the names
back. A partition remembers the blocks that it met last, within ``KEPT_BYTES``; so a block that a third of all texts share
is sent about once by each partition, and never gathered in one task.

Rows keep their place in their table as identity, so ids may be missing or repeat. A missing text counts
as empty, and all empty texts are equal. Of equal texts the row of the largest id stays (a missing id is below all
others); of rows that tie, the one that is last in its table. An empty table gives no rows; columns other than
id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, map_rows, row_keys

BLOCK_BYTES = 8192
KEPT_BYTES = 16 << 20
ROW = ["__file", "__row"]


def _cut(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Rows of two kinds: a ticket with the content of a block, and the places that hold this ticket."""

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        # From the block met longest ago to the latest one.
        seen: dict[bytes, tuple[int, int, int]] = {}
        held = 0
        for part in slices:
            out: dict[str, list] = {name: [] for name in ("ticket_file", "ticket_row", "ticket_at", "content", "__file", "__row", "at", "id", "sha", "blocks")}
            for file, row, name, text in zip(part["__file"], part["__row"], part["id"], part["text"], strict=True):
                data = (text or "").encode()
                cuts = range(0, len(data), block_bytes) or (0,)
                for at, begin in enumerate(cuts):
                    block = data[begin : begin + block_bytes]
                    ticket, content = seen.pop(block, None), None
                    if ticket is None:
                        ticket, content = (file, row, at), block
                        held += len(block) + 300
                    seen[block] = ticket
                    while held > KEPT_BYTES:
                        held -= len(oldest := next(iter(seen))) + 300
                        del seen[oldest]
                    first = at == 0
                    for column, value in zip(out, (*ticket, content, file, row, at, name if first else None, hashlib.sha256(data).digest() if first else None, len(cuts)), strict=True):
                        out[column].append(value)
            yield out

    kind = docs.schema["id"].dataType.simpleString()
    return map_rows(
        docs,
        "ticket_file long, ticket_row long, ticket_at int, content binary, __file long, __row long, at int, "
        f"id {kind}, sha binary, blocks int",
        rows,
    )


def _numbered(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names for a sorted partition: its number and the place of each content among the different ones."""
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 40
    last, name = None, base - 1
    for part in parts:
        names = []
        for content in part.column("content"):
            content = content.as_buffer()
            if last is None or not content.equals(last):
                name += 1
                last = content
            names.append(name)
        tickets = [part.column(c) for c in ("ticket_file", "ticket_row", "ticket_at")]
        yield pa.RecordBatch.from_arrays([*tickets, pa.array(names, pa.int64())], ["ticket_file", "ticket_row", "ticket_at", "name"])


def _name_pairs(pairs: DataFrame) -> DataFrame:
    """Replace ``left`` and ``right`` by one name for each different pair, in the order of the pairs."""
    sides = ["left", "right"]
    names = pairs.select(*sides).distinct().repartitionByRange(*sides).sortWithinPartitions(*sides)
    names = checkpointed(names.withColumn("name", F.monotonically_increasing_id()))
    return pairs.join(names, sides).drop(*sides)


def name_texts(
    docs: DataFrame, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``__file``, ``__row``, the id, ``sha`` (SHA-256 of the text), ``blocks`` and ``name``.

    Equal ``blocks`` and ``name`` mean equal texts. The result is kept in the shared folder.
    """
    base = row_keys(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *ROW)
    cut = _cut(base, block_bytes)
    tickets = ["ticket_file", "ticket_row", "ticket_at"]
    # The places are small; the blocks themselves are shuffled once, to be named.
    contents = cut.filter(F.col("content").isNotNull()).select(*tickets, "content")
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    contents = contents.repartition(partitions, "content").sortWithinPartitions("content")
    names = contents.mapInArrow(_numbered, "ticket_file long, ticket_row long, ticket_at int, name long")
    places = cut.select(*tickets, *ROW, "at", "id", "sha", "blocks")
    places = checkpointed(places.join(names, tickets).drop(*tickets))

    first = places.filter("at = 0").select(*ROW, "id", "sha", "blocks", "name")
    done = [first.filter("blocks = 1")]
    level = places.filter("blocks > 1").select(*ROW, "at", "blocks", "name")
    height = max((level.agg(F.max("blocks")).first()[0] or 1) - 1, 0).bit_length()
    for _ in range(height):
        side = lambda odd: F.max(F.when(F.col("at") % 2 == odd, F.col("name")))
        pairs = level.groupBy(*ROW, "blocks", F.floor(F.col("at") / 2).cast("int").alias("at")).agg(
            side(0).alias("left"), F.coalesce(side(1), F.lit(-1)).alias("right")
        )
        level = checkpointed(_name_pairs(checkpointed(pairs)))
    if height:
        top = level.select(*ROW, "name")
        done.append(first.filter("blocks > 1").drop("name").join(top, ROW))
    named = done[0]
    for more in done[1:]:
        named = named.unionByName(more)
    return checkpointed(named) if height else named


def exact_duplicates(
    docs: DataFrame, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: its place, the id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` in hex."""
    named = name_texts(docs, block_bytes, id_col, text_col)
    same = ["blocks", "name"]
    groups = named.groupBy(*same).agg(F.max(F.struct("id", *ROW)).alias("stays"), F.count("*").alias("group_size"))
    # Kept apart from the join, so that the join may split a group that has very many rows.
    rows = named.join(checkpointed(groups), same)
    return rows.select(
        *ROW,
        F.col("id").alias(id_col),
        F.col("stays.id").alias("keep_id"),
        "group_size",
        ((F.col("stays.__file") == F.col("__file")) & (F.col("stays.__row") == F.col("__row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
