"""The index of trip ids that the cleaned layer has taken in.

Ids are dealt to ``BUCKETS`` partitions by a hash, and each batch adds a file to the buckets that it has new ids for, sorted
by id and with a Bloom filter in each row group. A batch opens only the buckets that its own ids fall into. A batch of up
to ``LISTED`` ids also asks for these by name, so that of a bucket only row groups that can hold one of them are
read. ``compact`` puts the files of many batches together.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import KEY
from ..sources import Layers
from ..sources.layers import drop_partitions

# A divisor of ``ranked.SLOTS``, so that the slot of an id tells its bucket.
BUCKETS = 16
# Ids that are listed in the filter of a scan.
LISTED = 200


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), BUCKETS).cast("int")


def in_buckets(rows: DataFrame) -> DataFrame:
    """Ids of a bucket together and sorted, so that it gets one file, or several of Spark's advised size."""
    return rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", KEY)


def touched_buckets() -> list[Column]:
    """Measures of a batch: its buckets, of which there are ``BUCKETS`` at most, and how many ids it has."""
    return [F.collect_set("bucket").alias("buckets"), F.count(F.lit(1)).alias("ids")]


def measured_by_slots(ids: DataFrame, slots: Collection[int]) -> dict:
    """The same measures from the slots of the ids, ``ranked.SLOTS`` at most; beyond ``LISTED``, ids are not counted to the end."""
    # Ids are at least as many as their slots, so only a batch that may have few is asked for them.
    number = ids.limit(LISTED + 1).count() if len(slots) <= LISTED else len(slots)
    return {"buckets": sorted({slot % BUCKETS for slot in slots}), "ids": number}


def index_part(seen: DataFrame, ids: DataFrame, measured: Mapping, batch_id: int) -> DataFrame | None:
    """Ids that batches before this one have taken in, as far as they can be ids of the batch; nothing if there were none.

    ``ids`` holds each id once.
    """
    if not batch_id:
        return None
    seen = seen.filter(F.col("batch_id") < batch_id).filter(F.col("bucket").isin(sorted(measured["buckets"])))
    if measured["ids"] <= LISTED:
        session = seen.sparkSession
        session.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(LISTED))
        seen = seen.filter(F.col(KEY).isin([row[0] for row in ids.select(KEY).collect()]))
    return seen.select(KEY)


def earlier_ids(seen: DataFrame, ids: DataFrame, measured: Mapping, batch_id: int) -> DataFrame | None:
    """Ids of a batch that batches before it have taken in; nothing if there were none.

    ``ids`` holds each id once. While Spark measures them as few enough, they go to where the index lies, which is
    then read but not shuffled.
    """
    part = index_part(seen, ids, measured, batch_id)
    return None if part is None else part.join(ids.select(KEY), KEY, "left_semi").select(KEY)


def compact(layers: Layers) -> None:
    """Put the ids of all batches but the last into one file for each bucket.

    They become ids of the last of these batches. The files of the others go only once that is stored, and an id that is
    there twice does no harm, so a crash in between loses nothing and the call can be repeated.
    """
    session = layers.spark.newSession()
    name = layers.create("seen_ids")
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    batches = sorted(row[0] for row in session.table(name).select("batch_id").distinct().collect())
    if len(batches) < 3:
        return
    *merged, into, _ = batches
    ids = session.table(name).filter(F.col("batch_id") <= into).select(KEY, "bucket").distinct()
    rows = ids.withColumn("batch_id", F.lit(into).cast("bigint"))
    in_buckets(rows).select(*session.table(name).columns).write.insertInto(name, overwrite=True)
    for batch in merged:
        drop_partitions(session, name, batch_id=batch)
    layers.spark.catalog.refreshTable(name)
