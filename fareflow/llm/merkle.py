"""Merkle dataset manifest (operator 11): hash trees over the rows of a table, one per group, joined to one root.

Leaves of a group stand in order; every ``FAN`` neighbours are hashed to one node of the next level (the last run may be
shorter, even a single node) until one is left, the subroot. Subroots in the order of their groups are the leaves of a
tree of the same kind, whose top is the root. A digest is lower-case hex of SHA-256, and is hashed as that text.

A tree is cut into aligned subtrees of ``FAN ** HEIGHT`` leaves. Each is one row of a stored table, with its nodes in a van
Emde Boas layout: the subtree is cut at half its height, the upper half comes first, then the lower halves from left to
right, each laid out in the same way. ``address`` gives the place of a node by arithmetic alone; building reads
children by it and proofs read siblings by it. Roots of blocks are the leaves of the next table, up to one block per
tree. So a group of any size is work on blocks of bounded size: a source that holds a third of all rows is many of them.

Proofs go the other way, from the one block of the top tree down: each block hands its children the siblings on their way
up. Only digests travel, never the fields they are made of.

Rows of a group are ordered by the given columns (nulls first), then by digest; rows that tie on these have equal leaves, so
their proofs may change places but the set of results is the same. A missing group comes first, before the empty one. An
empty table has no root and no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder
from .common import checkpointed, map_rows

FAN = 3
HEIGHT = 8
BLOCK = FAN**HEIGHT
_DIGEST = 32


def _size(levels: int) -> int:
    """Nodes of a full tree of so many levels."""
    return (FAN**levels - 1) // (FAN - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` (0 for the root) in the layout of a full tree."""
    index = np.asarray(index, np.int64)
    place = np.zeros(len(index), np.int64)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        lower, below = levels - upper, depth - upper
        place += _size(upper) + index // FAN**below * _size(lower)
        index, levels, depth = index % FAN**below, lower, below
    return place


def _height(leaves: int) -> int:
    """Levels of the smallest tree with room for so many leaves."""
    levels = 1
    while FAN ** (levels - 1) < leaves:
        levels += 1
    return levels


def build_block(leaves: Sequence[bytes], levels: int) -> bytes:
    """All nodes over some leaves, in the layout; nodes that do not exist are zeros."""
    nodes = np.zeros((_size(levels), _DIGEST), np.uint8)
    level = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, _DIGEST)
    nodes[address(levels, levels - 1, np.arange(len(level)))] = level
    for depth in range(levels - 2, -1, -1):
        children = nodes[address(levels, depth + 1, np.arange(len(level)))].tobytes().hex().encode()
        run = 2 * _DIGEST * FAN
        made = b"".join(sha256(children[at : at + run]).digest() for at in range(0, len(children), run))
        level = np.frombuffer(made, np.uint8).reshape(-1, _DIGEST)
        nodes[address(levels, depth, np.arange(len(level)))] = level
    return nodes.tobytes()


def block_levels(nodes: bytes, levels: int, leaves: int) -> list[str]:
    """The nodes of a block as hex text, from its leaves up to its root."""
    laid = np.frombuffer(nodes, np.uint8).reshape(-1, _DIGEST)
    out = []
    for depth in range(levels - 1, -1, -1):
        out.append(laid[address(levels, depth, np.arange(leaves))].tobytes().hex())
        leaves = -(-leaves // FAN)
    return out


def siblings(levels: list[str], index: int) -> Iterator[tuple[str, str]]:
    """What stands to the left and to the right of a leaf's ancestors in their runs, level by level below the root."""
    width = 2 * _DIGEST
    for level in levels[:-1]:
        run = index // FAN * FAN * width
        at = index * width
        yield level[run:at], level[at + width : run + FAN * width]
        index //= FAN


def fold(leaf: str, steps: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in steps:
        leaf = sha256((left + leaf + right).encode()).hexdigest()
    return leaf


def _placed(rows: DataFrame, order: Sequence[str], total: str = "total") -> DataFrame:
    """Add ``idx``, the place of a row in its ``key``, and the rows of the key.

    Rows are sorted by ranges over all columns of the order, so a large group spans many partitions; what a group
    has in each partition is counted, and rows learn what comes before by partition and group together.
    """
    order = ["key", *order]
    rows = rows.withColumn("__tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*order, "__tie").sortWithinPartitions(*order, "__tie").drop("__tie")
    rows = checkpointed(rows.withColumn("__at", F.monotonically_increasing_id()))
    rows = rows.withColumn("__part", F.shiftright("__at", 33))
    runs = rows.groupBy("key", "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    # As many rows for a key as it spans partitions.
    key = Window.partitionBy("key")
    earlier = key.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "key", "__part", "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"), F.sum("__n").over(key).alias(total)
    )
    rows = rows.join(checkpointed(runs), ["key", "__part"])
    return rows.withColumn("idx", F.col("__at") - F.col("__first") + F.col("__before")).drop("__at", "__part", "__first", "__before")


def _block_row(payload: list[str]) -> Callable[[pa.Table], pa.Table]:
    """From the rows of one block to the row that stores it."""

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by([("idx", "ascending")])
        total, n = group["total"][0].as_py(), group.num_rows
        levels = HEIGHT + 1 if total > BLOCK else _height(n)
        nodes = build_block(group["digest"].to_pylist(), levels)
        fields = {name: group[name][:1] for name in ("key", "block", "total")}
        fields |= {"n": pa.array([n], pa.int32()), "levels": pa.array([levels], pa.int32())}
        fields |= {"nodes": pa.array([nodes], pa.binary()), "root": pa.array([nodes[:_DIGEST]], pa.binary())}
        for name in payload:
            fields[name] = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), group[name].combine_chunks())
        return pa.table(fields)

    return build


def _stored_levels(rows: DataFrame, payload: dict[str, str], folder: str) -> list[DataFrame]:
    """The tables of blocks, lowest first. ``rows`` has ``key``, ``idx``, ``total``, ``digest`` and ``payload`` columns."""
    levels: list[DataFrame] = []
    most = rows.agg(F.max("total")).first()[0] or 0
    while True:
        schema = "key string, block long, total long, n int, levels int, nodes binary, root binary"
        schema += "".join(f", {name} array<{kind}>" for name, kind in payload.items())
        blocks = rows.withColumn("block", F.expr(f"idx div {BLOCK}")).groupBy("key", "block").applyInArrow(_block_row(list(payload)), schema)
        path = f"{folder}/level-{len(levels)}"
        blocks.write.parquet(path)
        blocks = rows.sparkSession.read.parquet(path)
        levels.append(blocks)
        if most <= BLOCK:
            return levels
        most = -(-most // BLOCK)
        payload = {}
        rows = blocks.filter(F.col("total") > BLOCK).select(
            "key", F.col("block").alias("idx"), F.expr(f"(total + {BLOCK - 1}) div {BLOCK}").alias("total"), F.col("root").alias("digest")
        )


@dataclass
class Manifest:
    """Stored trees: ``levels`` of the groups and ``top`` of their subroots, lowest first, and the root in hex."""

    levels: list[DataFrame]
    top: list[DataFrame]
    root: str | None


def group_key(group: Column) -> Column:
    """Text of which missing groups come first, and others in the order of their bytes."""
    return F.when(group.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), group.cast("string")))


def row_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of all fields one after the other: ``-`` if missing, else the number of bytes, a colon and the value."""
    texts = [field.cast("string") for field in fields]
    return F.sha2(
        F.concat(*[F.when(x.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x)) for x in texts]), 256
    )


def build_manifest(rows: DataFrame, order: Sequence[str], payload: dict[str, str], folder: str | None = None) -> Manifest:
    """Trees over ``rows``: ``key`` (see ``group_key``), ``digest`` (binary), the ``order`` within a group, and ``payload``.

    ``payload`` names columns, with their types, that the lowest blocks keep beside their leaves.
    """
    folder = folder or f"{shared_folder(rows.sparkSession)}/manifest"
    wanted = dict.fromkeys(["key", "digest", *order, *payload])
    levels = _stored_levels(_placed(rows.select(*wanted), [*order, "digest"]), payload, f"{folder}/groups")
    subroots = levels[0].filter(F.col("total") <= BLOCK).select(F.col("key").alias("name"), F.col("root").alias("digest"))
    for blocks in levels[1:]:
        subroots = subroots.union(blocks.filter(F.col("total") <= BLOCK).select("key", "root"))
    subroots = subroots.withColumn("key", F.lit(""))
    top = _stored_levels(_placed(subroots, ["name"]), {"name": "string"}, f"{folder}/top")
    last = top[-1].select("root").first()
    return Manifest(levels, top, bytes(last[0]).hex() if last else None)


_STEPS = "array<struct<left:string,right:string>>"


def _with_ways(levels: list[DataFrame], tops: DataFrame | None = None) -> DataFrame:
    """The lowest blocks with ``above``, the steps from their root to the end of ``tops``, and the ``subroot`` of their tree.

    ``tops`` has the ``key`` of each tree and the steps above it; without it, there are none.
    """

    def down(slices: Iterator[dict]) -> Iterator[dict]:
        for part in slices:
            names = ("key", "block", "n", "levels", "nodes", "above", "subroot")
            for key, block, n, height, nodes, above, subroot in zip(*(part[c] for c in names), strict=True):
                laid = block_levels(nodes, height, n)
                ways = [[{"left": a, "right": b} for a, b in siblings(laid, i)] + above for i in range(n)]
                yield {"key": [key] * n, "block": [block * BLOCK + i for i in range(n)], "above": ways, "subroot": [subroot] * n}

    ways = None
    for place in range(len(levels) - 1, -1, -1):
        blocks = levels[place]
        held = blocks.filter(F.col("total") <= BLOCK).withColumn("subroot", F.lower(F.hex("root")))
        held = held.withColumn("above", F.array().cast(_STEPS)) if tops is None else held.join(tops, "key")
        if ways is not None:
            held = held.unionByName(blocks.filter(F.col("total") > BLOCK).join(ways, ["key", "block"]))
        if place:
            narrow = held.select("key", "block", "n", "levels", "nodes", "above", "subroot")
            ways = checkpointed(map_rows(narrow, f"key string, block long, above {_STEPS}, subroot string", down))
    return held


def lowest_blocks(manifest: Manifest) -> DataFrame:
    """Lowest blocks of all groups with their payload, ``subroot``, and the steps ``above`` up to the root of all."""

    def names(slices: Iterator[dict]) -> Iterator[dict]:
        for part in slices:
            for n, height, nodes, held, above in zip(*(part[c] for c in ("n", "levels", "nodes", "name", "above")), strict=True):
                laid = block_levels(nodes, height, n)
                yield {"key": held, "above": [[{"left": a, "right": b} for a, b in siblings(laid, i)] + above for i in range(n)]}

    top = _with_ways(manifest.top).select("n", "levels", "nodes", "name", "above")
    return _with_ways(manifest.levels, checkpointed(map_rows(top, f"key string, above {_STEPS}", names)))


def prove(manifest: Manifest, names: str, kind: str, tampered: str) -> DataFrame:
    """Per row: the payload ``names`` (of type ``kind``), ``leaf``, ``subroot``, ``proof`` and ``folded_root``.

    ``proof`` holds the siblings from the leaf up to the root. The root is folded from the digest in the payload column
    ``tampered``, or from the leaf where that is missing.
    """

    def rows(slices: Iterator[dict]) -> Iterator[dict]:
        for part in slices:
            held = zip(*(part[c] for c in ("names", "changed", "n", "levels", "nodes", "above", "subroot")), strict=True)
            for ids, changed, n, height, nodes, above, subroot in held:
                laid = block_levels(nodes, height, n)
                rest = [(step["left"], step["right"]) for step in above]
                tail = "".join(left + right for left, right in rest)
                # Rows of a slice, so that proofs of a whole block are never held at once.
                for begin in range(0, n, 1024):
                    out: dict[str, list] = {c: [] for c in (names, "leaf", "subroot", "proof", "folded_root")}
                    for i in range(begin, min(n, begin + 1024)):
                        steps = list(siblings(laid, i))
                        leaf = laid[0][64 * i : 64 * i + 64]
                        out[names].append(ids[i])
                        out["leaf"].append(leaf)
                        out["subroot"].append(subroot)
                        out["proof"].append("".join(left + right for left, right in steps) + tail)
                        out["folded_root"].append(fold(leaf if changed[i] is None else changed[i].hex(), steps + rest))
                    yield out

    blocks = lowest_blocks(manifest).select(
        F.col(names).alias("names"), F.col(tampered).alias("changed"), "n", "levels", "nodes", "above", "subroot"
    )
    return map_rows(blocks, f"`{names}` {kind}, leaf string, subroot string, proof string, folded_root string", rows)
