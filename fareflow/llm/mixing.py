"""Mixing sources to target weights (operator 7) by pivotal dependent rounding.

A source's target over its size is how often each of its documents should be taken: a whole number of times, and
a fraction that has to be rounded. Two documents at a time, fractions are paired and mass moves from one to
the other, in a random direction with the chances that keep each one's expectation, until one is whole. Mass
counts in words (``size * fraction``), so the words that a source gives do not change at all on the way.

The pairing is a reduction tree. Groups of documents of a source are reduced side by side, each to at most one
document that is still a fraction; such residuals meet in groups of ``FAN_IN`` on the next level, until a source
has one left, which goes to the nearer whole number. So a source misses its target by half a document at most.

Draws come from ids and places in the table, so reruns agree. A missing text or an empty one has no words; it takes
no part in the exchange and is rounded by itself. Rows may repeat and ids may be missing: each row gets a
row. A missing source is a source of its own, the last one. An empty table gives no rows; other columns
are not read. A source may hold any share of the rows: its groups have some ``GROUP_ROWS`` rows each.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, numbered, row_keys

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SEED = 7
GROUP_ROWS = 4096
FAN_IN = 64
ROW = ["__file", "__row"]


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """Per source: ``rows``, ``source_size`` and ``target``.

    Sources in the order of their names take the weights in turns. What would go beyond ``most`` times a
    source's size is shared again by weight among the others, until no target is above that.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    sources = numbered(sources, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = checkpointed(sources.withColumns({"weight": weight, "cap": F.col("source_size") * most}))
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        full = F.col("weight") * level > F.col("cap")
        now, used, free = sources.agg(
            F.count_if(full), F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        if now == capped or not free:
            break
        level, capped = (total - used) / free, now
    target = F.least(F.col("weight") * level, F.col("cap"))
    return sources.select("source", "rows", "source_size", target.cast("double").alias("target"))


def _draw(*keys: object) -> float:
    return xxhash.xxh64_intdigest("|".join(map(str, keys)), SEED) / 2.0**64


def _reduce(group: pd.DataFrame) -> pd.DataFrame:
    """Pair the fractions of a group until at most one is left. Large sizes go first, so that what is left is small."""
    group = group.sort_values(["size", "key"], ascending=[False, True], kind="stable").reset_index(drop=True)
    sizes, keys, fractions = group["size"].tolist(), group["key"].tolist(), group["fraction"].tolist()
    open_ = None
    for j, p in enumerate(fractions):
        if not 0.0 < p < 1.0:
            continue
        if sizes[j] == 0:
            fractions[j] = float(_draw(keys[j]) < p)
            continue
        if open_ is None:
            open_ = j
            continue
        i = open_
        ratio = sizes[j] / sizes[i]
        up = min(1.0 - fractions[i], p * ratio)
        down = min(fractions[i], (1.0 - p) * ratio)
        step = up if _draw(keys[i], keys[j]) < down / (up + down) else -down
        fractions[i] += step
        fractions[j] -= step / ratio
        for k in (i, j):
            if fractions[k] < 1e-9:
                fractions[k] = 0.0
            elif fractions[k] > 1.0 - 1e-9:
                fractions[k] = 1.0
        left = [k for k in (i, j) if 0.0 < fractions[k] < 1.0]
        # Rounding may leave both open by a hair; the one nearer to a whole number gets there.
        if len(left) == 2:
            near = min(left, key=lambda k: min(fractions[k], 1.0 - fractions[k]))
            fractions[near] = float(round(fractions[near]))
            left.remove(near)
        open_ = left[0] if left else None
    group["fraction"] = fractions
    return group


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **shares) -> DataFrame:
    """Per row: its place, the id, ``size`` in words, ``source_size``, ``target`` and ``copies``.

    ``shares`` are the parameters of ``source_targets``. The result is kept in the shared folder.
    """
    words = F.regexp_count(F.coalesce(text_col, F.lit("")), F.lit("[^ \\t-\\r]+")).cast("long")
    base = row_keys(docs).select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), *ROW, words.alias("size"))
    base = checkpointed(base)
    targets = checkpointed(source_targets(base, **shares))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    groups = F.ceil(F.col("rows") / GROUP_ROWS)
    # A few numbers per source; a source that holds many rows is split by the join itself.
    rows = base.join(targets, base["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    rows = rows.select(
        *ROW,
        "id",
        "source",
        "size",
        "source_size",
        "target",
        F.floor(rate).alias("whole"),
        (rate - F.floor(rate)).alias("fraction"),
        F.concat_ws("/", F.col("id").cast("string"), F.col("__row").cast("string")).alias("key"),
        groups.alias("groups"),
        F.pmod(F.xxhash64("id", "__row"), groups).alias("part"),
    )
    schema = rows.schema
    most = math.ceil((targets.agg(F.max("rows")).first()[0] or 1) / GROUP_ROWS)
    done = []
    still = F.col("fraction").between(0.0, 1.0) & ~F.col("fraction").isin(0.0, 1.0)
    while True:
        rows = checkpointed(rows.groupBy("source", "part").applyInPandas(_reduce, schema))
        if most <= 1:
            done.append(rows.withColumn("fraction", F.round("fraction")))
            break
        done.append(rows.filter(~still))
        rows = rows.filter(still).withColumn("part", F.floor(F.col("part") / FAN_IN))
        most = math.ceil(most / FAN_IN)
    mixed = done[0]
    for more in done[1:]:
        mixed = mixed.unionByName(more)
    return mixed.select(
        *ROW, F.col("id").alias(id_col), "size", "source_size", "target", (F.col("whole") + F.col("fraction")).cast("long").alias("copies")
    )
