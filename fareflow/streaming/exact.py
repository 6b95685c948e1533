"""Cleaned layer as a stream that takes in each trip id once, ever, and always its first copy.

Ids taken in so far are kept in a table rather than in the state store: an index in buckets, of which a batch opens those
that can hold its ids. Each batch makes one decision, and stores it before anything else: its rows, shuffled to their ids
once, with their rank among the copies of the batch and whether the index has the id. First copies of ids that the index
lacks become cleaned rows, and their ids are stored; every other row with an id goes to the duplicate log. So the two never
disagree, however a stream is paced, and no batch goes through earlier rows again. All tables of a batch come from the
stored rows. How many rows broke each rule is counted while the cleaned rows are written, and so is the size of each write.

Each write replaces the partition of its own batch, and ids of the running batch are not looked at, so a batch
that runs again after a crash gives the same rows, sums and counts.

Over several batches, the first copy is the one taken in first. That is the first by arrival time, as
raw rows come in by arrival. If options pace the stream so that rows with one arrival time fall into
different batches, the batch comes before the file name and the other columns that break such ties.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import checked_lookup, expect_or_drop, observe_rules
from ..plans import gold
from ..plans.errors import duplicate_log, duplicate_rows, prepared_firsts
from ..plans.silver import derive, prepare
from ..schema import KEY, QUALITY_LOG, RULES
from ..sources import Layers, without_metadata
from ..sources.layers import drop_partitions, quoted
from .ranked import HOT_ROWS, is_hot, slot_sizes, split_ranked, store_ranked
from .seen import bucket_of, in_buckets, index_part, measured_by_slots


# Files that a task writes at once: more than any table has parts in a batch.
OPEN_FILES = 64


def _store_batch(rows: DataFrame, table: str, batch_id: int) -> int:
    """Replace the partition of one batch; gives the number of its rows, which is counted by the write itself.

    The session is the stream's own, so its setting stays here.
    """
    session = rows.sparkSession
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    columns = session.table(table).columns
    # A file is open for each part of the batch, so rows need not be sorted by part, and spilled, to be written.
    session.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))
    rows = without_metadata(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).select(*map(quoted, columns)))
    written = Observation()
    rows.observe(written, F.count(F.lit(1)).alias("n")).write.insertInto(table, overwrite=True)
    if not written.get["n"]:
        # Overwriting with nothing leaves what an earlier attempt at this batch has written.
        drop_partitions(session, table, batch_id=batch_id)
    return written.get["n"]


# Tables with what each batch adds to the aggregates.
SUMS = {"zone_sums": gold.zone_sums, "hour_sums": gold.hour_sums, "driver_sums": gold.driver_sums}

# What the quality log counts beside the rules.
_OTHERS = {"unparsed_times": "trip_duration IS NULL", "backwards_times": "trip_duration <= 0"}


def _is_stored(session, table: str, batch_id: int) -> bool:
    return not session.sql(f"SHOW PARTITIONS {table} PARTITION (batch_id = {batch_id})").isEmpty()


def _store_cleaned(derived: DataFrame, rules: Mapping[str, str], on_null: str, table: str, batch_id: int) -> Mapping[str, int]:
    """Store the rows of a batch that meet the rules; gives what was counted on the way.

    After a crash the rows may be there already. Files that are whole stay as they are: rewritten under new names, a
    stream over them would count them again.
    """
    session = derived.sparkSession
    quality = Observation()
    observed = observe_rules(derived, quality, RULES, _OTHERS)
    cleaned = expect_or_drop(observed, rules, on_null)
    if _is_stored(session, table, batch_id):
        wanted = Observation()
        cleaned.observe(wanted, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
        if session.table(table).filter(F.col("batch_id") == batch_id).count() == wanted.get["n"]:
            return quality.get
    _store_batch(cleaned, table, batch_id)
    return quality.get


def silver_stage(
    layers: Layers,
    lookup: DataFrame | None = None,
    rules: Mapping[str, str] = RULES,
    on_null: str = "keep",
    **options: str | int,
) -> StreamingQuery:
    """Start bringing the cleaned layer up to date with the raw layer; ``options`` pace the stream."""
    if lookup is not None:
        lookup = checked_lookup(lookup)
    trips = layers.stream("bronze_trips", **options)
    seen_ids = layers.create("seen_ids")
    silver = layers.create("silver_trips", derive(prepare(trips), lookup).schema)
    duplicates = layers.create("duplicate_log", duplicate_log(layers.read("bronze_trips")).schema)
    quality = layers.create("quality_log")
    sums = {layers.create(table): per_batch for table, per_batch in SUMS.items()}
    staging = f"{layers.checkpoint('silver_trips')}-staging"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        sizes = slot_sizes(batch)
        asked = batch.select(KEY).filter(F.col(KEY).isNotNull()).distinct()
        seen = index_part(session.table(seen_ids), asked, measured_by_slots(asked, sizes), batch_id) if batch_id else None
        ranked = store_ranked(batch, seen, sizes, staging, HOT_ROWS)
        new, copies = split_ranked(ranked, is_hot(sizes, HOT_ROWS))
        ids = new.select(KEY).withColumn("bucket", bucket_of(KEY))
        _store_batch(in_buckets(ids), seen_ids, batch_id)
        _store_batch(duplicate_rows(copies), duplicates, batch_id)

        derived = derive(prepared_firsts(new), lookup)
        counted = _store_cleaned(derived, rules, on_null, silver, batch_id)
        entry = session.range(0, 1, 1, 1).select(*[F.lit(counted[name]).cast("long").alias(name) for name in QUALITY_LOG.names])
        _store_batch(entry, quality, batch_id)
        rows = session.table(silver).filter(F.col("batch_id") == batch_id)
        for table, per_batch in sums.items():
            _store_batch(per_batch(rows), table, batch_id)

    return (
        trips.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", layers.checkpoint("silver_trips"))
        .trigger(availableNow=True)
        .start()
    )
