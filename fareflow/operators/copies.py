"""Several rows with one trip id: which copy is first, and which copies came later.

"First" means arrival time, then source file, then all other columns. Rows that tie on all of
these are exact copies, so it makes no difference which of them counts as first.

One id may hold a large part of all rows. Both sides are built so that such an id never ends up in
one task:

* ``first_copies`` filters on ``row_number = 1``, which Spark also applies before the shuffle
  (WindowGroupLimit), so each input split sends at most one row per id.
* ``later_copies`` ranks the copies of an id inside each input split, and then ranks only the best
  copy of every split. No group exceeds one split, or one row per split.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ARRIVAL, KEY, WATERMARK_DELAY
_UNORDERED = (T.MapType, T.VariantType)


def copy_order(rows: DataFrame, key: str = KEY, lead: tuple[str, ...] = (ARRIVAL, "source_file")) -> list[str]:
    """Columns that order the copies of one key: the ``lead`` columns, then every other column."""
    sortable = [f.name for f in rows.schema.fields if f.name != key and not isinstance(f.dataType, _UNORDERED)]
    leading = [name for name in lead if name in sortable]
    return [f"`{name}`" for name in leading + [name for name in sortable if name not in leading]]


def first_copies(rows: DataFrame, key: str = KEY, order: list[str] | None = None) -> DataFrame:
    """One row per non-null key: its first copy."""
    by_key = Window.partitionBy(key).orderBy(*(order or copy_order(rows, key)))
    return (
        rows.filter(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(by_key))
        .filter("_rank = 1")
        .drop("_rank")
    )


def later_copies(
    rows: DataFrame,
    key: str = KEY,
    order: list[str] | None = None,
    computed: Mapping[str, Column] | None = None,
) -> DataFrame:
    """All rows with a non-null key but the first copy of each key.

    ``order`` may name ``computed`` columns, which are worked out only for keys that repeat.
    """
    order = order or copy_order(rows, key)
    # Only ids that repeat need ranking. The count moves nothing but ids, added up per split first,
    # and the semi-join keeps ids that occur once out of both window shuffles.
    known = rows.filter(F.col(key).isNotNull())
    copies = known.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    # Adaptive execution splits a frequent key in a join only if both sides come straight from a
    # shuffle. A computed id makes Spark shuffle these few ids again instead of keeping their places.
    repeated = copies.filter("_copies > 1").select(F.concat(F.col(key), F.lit("")).alias(key))
    # The split number of a row is the same when a lost task runs again.
    split = known.withColumn("_split", F.spark_partition_id()).join(repeated, key, "left_semi")
    # The join leaves rows partitioned by key, which Spark would take for good enough here. Both
    # windows need their own shuffle to spread a frequent key.
    in_split = Window.partitionBy(key, "_split").orderBy(*order)
    spread = split.repartition(key, "_split").withColumns(dict(computed or {}))
    ranked = spread.withColumn("_local", F.row_number().over(in_split))
    # Best copies of all splits form one group per key; the others stay in the group of their split.
    group = F.when(F.col("_local") > 1, F.col("_split")).otherwise(F.lit(-1))
    of_best = Window.partitionBy(key, "_group").orderBy(*order)
    return (
        ranked.withColumn("_group", group)
        .withColumn("_rank", F.row_number().over(of_best))
        .filter((F.col("_local") > 1) | (F.col("_rank") > 1))
        .select(*[f"`{name}`" for name in rows.columns])
    )


def unseen(rows: DataFrame, seen: DataFrame, key: str = KEY) -> DataFrame:
    """Rows whose key is not in ``seen``; ``rows`` holds each key once and ``seen`` may be huge.

    Matches are picked out first: while Spark measures the keys of ``rows`` as few enough, they go to where
    ``seen`` lies, which is then scanned but not shuffled.
    """
    matches = seen.join(rows.select(key), key, "left_semi").select(key)
    return rows.join(matches, key, "left_anti")


def stream_first_copies(
    rows: DataFrame,
    key: str = KEY,
    policy: str = "bounded",
    event_time: str = ARRIVAL,
    delay: str = WATERMARK_DELAY,
) -> DataFrame:
    """De-duplicate a stream by key in the state store; any copy may survive.

    ``unbounded`` remembers every key for good. ``bounded`` forgets a key once the watermark has
    passed it, and is exact only for copies that arrive within ``delay`` of each other. The exact
    policy with a defined first copy is the table-based stage in ``streaming.exact``.

    Copies are first removed per key and input split, then per key, so that a frequent key reaches
    the second step at most once per split.
    """
    per_split = [key, "_split"]
    spread = rows.filter(F.col(key).isNotNull()).withColumn("_split", F.spark_partition_id())
    if policy == "unbounded":
        return spread.dropDuplicates(per_split).dropDuplicates([key]).drop("_split")
    if policy == "bounded":
        marked = spread.withWatermark(event_time, delay)
        return marked.dropDuplicatesWithinWatermark(per_split).dropDuplicatesWithinWatermark([key]).drop("_split")
    raise ValueError(f"policy is 'bounded' or 'unbounded', not {policy!r}")
