"""Sharding (operator 10): descend region, rack and shard by weighted hash draws.

At each level the children of a node draw by the row's key: each child's draw is ``ln(u) / weight`` with ``u`` a hash
of the key and the child, and the largest wins, so that a child gets rows by its share of the weight.

What is added later takes part under its own generation: a node that grows enters the draw a second time, with
the weight that was added, and a row that this entry wins goes down to the new shard only. So the draws of all
that was there before stay as they are, and rows move only into the subtree whose weight changed. All of it is
built-in functions.

The key alone decides, together with the tree: rows with one key share a shard, and so do all rows
without a key. A missing text has no bytes. Each row gets a row, also if rows repeat; an empty table gives no
rows; other columns are not read. Slots number the rows of a shard from 0 without gaps, by id; rows with one
id are in the order of their size and checksum. They come from a range sort over all shards, in which many
rows with one key are still spread, and not from one window per shard.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

SEED = 20_17


@dataclass(frozen=True)
class Leaf:
    """A shard with its place; ``generation`` is 0 for those of the beginning and rises with each change."""

    region: str
    rack: str
    shard: int
    weight: float = 1.0
    generation: int = 0


def even_tree(shards: int, regions: int = 3, racks: int = 2) -> list[Leaf]:
    """Shards of equal weight, dealt to racks in turns."""
    return [Leaf(f"r{i % regions}", f"r{i % regions}k{i // regions % racks}", i) for i in range(shards)]


def grown(tree: Sequence[Leaf], shard: int, weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in the rack of least weight."""
    racks: dict[tuple[str, str], float] = {}
    for leaf in tree:
        racks[leaf.region, leaf.rack] = racks.get((leaf.region, leaf.rack), 0.0) + leaf.weight
    region, rack = min(racks, key=lambda place: (racks[place], place))
    return [*tree, Leaf(region, rack, shard, weight, 1 + max(leaf.generation for leaf in tree))]


def _drawn(key: Column, children: Column) -> Column:
    """Name of the child that wins; ``children`` is an array of (name, weight)."""

    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, child["name"], F.lit(SEED)), 11)
        return F.struct((F.log((bits + 0.5) / float(1 << 53)) / child["weight"]).alias("draw"), child["name"].alias("name"))

    return F.array_max(F.transform(children, draw))["name"]


def _children(tree: Sequence[Leaf], level: int) -> dict[str, dict[str, float]]:
    """By name of a node above ``level``: the names and weights of what is below it. Names hold the generation."""
    found: dict[str, dict[str, float]] = {}
    for leaf in tree:
        names = ["", f"{leaf.generation}/{leaf.region}", f"{leaf.generation}/{leaf.region}/{leaf.rack}", f"shard {leaf.shard}"]
        below = found.setdefault(names[level], {})
        below[names[level + 1]] = below.get(names[level + 1], 0.0) + leaf.weight
    return found


def _literal(children: dict[str, float]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight")) for n, w in children.items()])


def place(df: DataFrame, key: str, tree: Sequence[Leaf], out: str) -> DataFrame:
    """Add the shard of each row as ``out``."""
    df = df.withColumn("__node", _drawn(F.col(key), _literal(_children(tree, 0)[""])))
    for level in (1, 2):
        by_node = F.create_map(*[x for n, c in _children(tree, level).items() for x in (F.lit(n), _literal(c))])
        df = df.withColumn("__node", _drawn(F.col(key), by_node[F.col("__node")]))
    return df.withColumn(out, F.substr("__node", F.lit(7)).cast("int")).drop("__node")


def shard_rows(
    docs: DataFrame, tree: Sequence[Leaf], larger: Sequence[Leaf], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: the id, ``size`` (bytes of the text and 8), ``text_crc32``, ``shard``, ``slot``, ``grown_shard``."""
    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("__key"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("__tie"),
    )
    rows = place(place(rows, "__key", tree, "shard"), "__key", larger, "grown_shard")
    order = ["shard", "__key", "size", "text_crc32", "__tie"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = checkpointed(rows.drop("__tie").withColumn("__at", F.monotonically_increasing_id()))

    # The rows of a shard lie together in each partition: where they begin, and how many come before.
    rows = rows.withColumn("__part", F.shiftright("__at", 33))
    runs = rows.groupBy("shard", "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    earlier = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("shard", "__part", "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    # A row for each partition, and one more for each shard: as few as there are tasks.
    rows = rows.join(F.broadcast(runs), ["shard", "__part"])
    return rows.select(
        F.col("__key").alias(id_col),
        "size",
        "text_crc32",
        "shard",
        (F.col("__before") + F.col("__at") - F.col("__first")).alias("slot"),
        "grown_shard",
    )
