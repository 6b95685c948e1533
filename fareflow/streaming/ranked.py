"""The copies of a batch, ranked in one shuffle of its rows.

Rows go to their id once. There the copies of an id are ranked and met with the ids that earlier batches have taken in, and
each row is stored with the verdict, so that neither the cleaned rows nor the duplicates have to be shuffled again.

An id with very many rows would make one task too large. Ids are counted by ``SLOTS`` slots of their hash, which takes
a few bytes per slot and input split. The rows of a slot with more than ``HOT_ROWS`` are dealt to slices by their input
split; they are ranked within each slice, and then the first copies of the slices are ranked among each other.

The rows of a task are sorted to be ranked. The more rows a batch has, the more tasks there are, so that these rows stay
in memory, however large the batch is.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sanitize_numeric
from ..plans.errors import batch_firsts_order, instants
from ..schema import KEY, MALFORMED
from ..sources import without_metadata
from ..sources.layers import COMPRESSION, quoted

SLOTS = 1 << 16
HOT_ROWS = 1_000_000
# Rows that a task ranks at once, about 300 bytes each; beyond it there are more tasks than the session's own number.
TASK_ROWS = 250_000
# Beside the columns of a row: the slice of its id, whether there are others, and what is known of it.
_OWN = ("_slice", "_hot", "_later", "_earlier")


def slot_sizes(batch: DataFrame) -> dict[int, int]:
    """Rows with an id, by slot of the id: at most ``SLOTS`` numbers."""
    slot = F.pmod(F.xxhash64(KEY), SLOTS).cast("int")
    return dict(batch.filter(F.col(KEY).isNotNull()).groupBy(slot.alias("slot")).agg(F.count(F.lit(1))).collect())


def _tasks(batch: DataFrame, sizes: dict[int, int], task_rows: int) -> list[int]:
    """How many tasks rank the batch, if the session's own number would give them too many rows."""
    tasks = math.ceil(sum(sizes.values()) / task_rows)
    return [tasks] if tasks > int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []


def _sliced(rows: DataFrame, sizes: dict[int, int], hot_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows with their slice, and the slots that have several slices."""
    hot = [(slot, math.ceil(n / hot_rows)) for slot, n in sorted(sizes.items()) if n > hot_rows]
    if not hot:
        return rows.withColumns({"_slice": F.lit(0), "_hot": F.lit(False)}), None
    slots = F.broadcast(rows.sparkSession.createDataFrame(hot, "_slot int, _slices int"))
    # The split number of a row is the same when a lost task runs again.
    split = rows.withColumns({"_split": F.spark_partition_id(), "_slot": F.pmod(F.xxhash64(KEY), SLOTS).cast("int")})
    joined = split.join(slots, "_slot", "left")
    own = {"_slice": F.coalesce(F.pmod("_split", "_slices"), F.lit(0)), "_hot": F.col("_slices").isNotNull()}
    return joined.withColumns(own).drop("_slot", "_split", "_slices"), slots


def store_ranked(
    batch: DataFrame, seen: DataFrame | None, sizes: dict[int, int], path: str, hot_rows: int = HOT_ROWS, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Store the typed rows of a batch that have an id, with their verdicts; ``seen`` holds ids taken in before."""
    tasks = _tasks(batch, sizes, task_rows)
    rows = sanitize_numeric(batch.drop(MALFORMED)).filter(F.col(KEY).isNotNull())
    order = batch_firsts_order(rows)
    rows, slots = _sliced(rows, sizes, hot_rows)
    # A slice that is the same for all rows would keep Spark from seeing that rows and ids taken in lie together.
    place = [KEY] if slots is None else [KEY, "_slice"]
    rank = F.row_number().over(Window.partitionBy(*place).orderBy(*order))
    # Times are parsed once, where the copies are ranked: they need not travel beside their text.
    ranked = rows.repartition(*tasks, *place).withColumns(instants()).withColumn("_later", rank > 1)
    if seen is None:
        ranked = ranked.withColumn("_earlier", F.lit(False))
    else:
        if slots is not None:
            seen = seen.withColumn("_slot", F.pmod(F.xxhash64(KEY), SLOTS).cast("int")).join(slots, "_slot", "left")
            seen = seen.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)))
        # An id may be in the index twice.
        seen = seen.select(*place)
        # Ids go to the same tasks as the rows at once.
        seen = (seen.repartition(*tasks, *place) if tasks else seen).distinct().withColumn("_known", F.lit(True))
        ranked = ranked.join(seen, place, "left").withColumn("_earlier", F.col("_known").isNotNull()).drop("_known")
    # The join puts its key first; rows keep the order of their columns.
    ranked = ranked.select(*[quoted(name) for name in rows.columns if name not in _OWN], *instants(), *_OWN)
    without_metadata(ranked).write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    stored = batch.sparkSession.read.schema(ranked.schema).parquet(path)
    return stored.withColumn("_hot", F.lit(False)) if slots is None else stored


def split_ranked(stored: DataFrame, any_hot: bool) -> tuple[DataFrame, DataFrame]:
    """From stored rows, those that are the first copy of a new id, with their times, and all others."""
    new = ~F.col("_later") & ~F.col("_earlier")
    if not any_hot:
        return stored.filter(new).drop(*_OWN), stored.filter(~new).drop(*_OWN, *instants())
    order = batch_firsts_order(stored.drop(*_OWN, *instants()))
    # A row for each slice of an id.
    firsts = stored.filter("_hot AND NOT _later")
    firsts = firsts.withColumn("_later", F.row_number().over(Window.partitionBy(KEY).orderBy(*order)) > 1)
    rows = stored.filter("NOT _hot OR _later").unionByName(firsts)
    return rows.filter(new).drop(*_OWN), rows.filter(~new).drop(*_OWN, *instants())


def is_hot(sizes: dict[int, int], hot_rows: int = HOT_ROWS) -> bool:
    return any(n > hot_rows for n in sizes.values())
