"""Aggregates by key that are kept up to date group by group.

The state store holds the running totals, and a batch hands on the groups that it has changed. The table is cut into
``PARTS`` by a hash of the key. A batch writes a new version of those parts that its groups fall into: their rows, with
the changed groups in place of the old ones. Other parts are neither read nor written. A commit row then names the version of
each part, and readers go by the last one, so they see a batch as a whole or not at all, and a batch that
runs again gives the same version. Versions that neither the last commit nor the one before it names are removed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import Layers
from ..sources.layers import drop_partitions, quoted
from .exact import _store_batch

PARTS = 32

# Tables that are kept in this way: the aggregate that each is, and its key.
KEYED = {
    "driver_totals": ("gold_driver_perf", ["driver_id"]),
    "zone_totals": ("gold_zone_revenue", ["pickup_zone", "dropoff_zone", "zone_id"]),
}


def _versions(session: SparkSession, commits: str, table: str, before: int | None = None) -> list[dict[int, int]]:
    """The versions of the parts by the last two commits, latest first."""
    rows = session.table(commits).filter(F.col("of") == table)
    if before is not None:
        rows = rows.filter(F.col("batch_id") < before)
    return [dict(row.versions) for row in rows.orderBy(F.col("batch_id").desc()).limit(2).collect()]


def _in_version(versions: dict[int, int]) -> Column:
    """Rows of the named versions. There are at most ``PARTS`` of them, and Spark prunes all other partitions."""
    by_batch: dict[int, list[int]] = {}
    for part, batch in versions.items():
        by_batch.setdefault(batch, []).append(part)
    named = [(F.col("batch_id") == batch) & F.col("part").isin(sorted(parts)) for batch, parts in by_batch.items()]
    return reduce(lambda a, b: a | b, named, F.lit(False))


def _remove_old(session: SparkSession, name: str, kept: list[dict[int, int]]) -> None:
    named = {pair for versions in kept for pair in versions.items()}
    for (spec,) in session.sql(f"SHOW PARTITIONS {name}").collect():
        part, batch = (int(field.split("=")[1]) for field in spec.split("/"))
        if (part, batch) not in named:
            drop_partitions(session, name, part=part, batch_id=batch)


def keyed_stage(layers: Layers, table: str, **options: str | int) -> StreamingQuery:
    """Bring a keyed table up to date with the cleaned layer; only parts with changed groups are written."""
    from .stages import GOLD

    aggregate, key = KEYED[table]
    name, commits = layers.create(table), layers.create(f"{table}_commits")

    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        changed = batch.withColumn("part", F.pmod(F.xxhash64(*key), PARTS).cast("int")).persist()
        try:
            touched = [row[0] for row in changed.select("part").distinct().collect()]
            last = _versions(session, commits, table, batch_id)
            current = last[0] if last else {}
            old = session.table(name).filter(_in_version({part: v for part, v in current.items() if part in touched}))
            again = changed.select(*[F.col(c).alias(f"_{c}") for c in key])
            same = reduce(lambda a, b: a & b, [old[c].eqNullSafe(again[f"_{c}"]) for c in key])
            columns = [quoted(c) for c in session.table(name).columns if c != "batch_id"]
            rows = old.join(again, same, "left_anti").select(*columns).unionByName(changed.select(*columns))
            _store_batch(rows.repartition("part"), name, batch_id)
            versions = current | dict.fromkeys(touched, batch_id)
            named = F.map_from_arrays(*[F.array(*map(F.lit, x)) for x in (versions.keys(), versions.values())]) if versions else F.create_map()
            commit = session.range(0, 1, 1, 1).select(F.lit(table).alias("of"), named.cast("map<int,bigint>").alias("versions"))
            _store_batch(commit, commits, batch_id)
            _remove_old(session, name, [versions, current])
        finally:
            changed.unpersist()

    return (
        GOLD[aggregate](layers.stream("silver_trips", **options))
        .writeStream.outputMode("update")
        .foreachBatch(merge)
        .option("checkpointLocation", layers.checkpoint(table))
        .trigger(availableNow=True)
        .start()
    )


def read_keyed(layers: Layers, table: str) -> DataFrame:
    """The rows of a keyed table as of its last commit."""
    name, commits = layers.name(table), layers.name(f"{table}_commits")
    for each in (name, commits):
        layers.spark.catalog.refreshTable(each)
    last = _versions(layers.spark, commits, table)
    return layers.spark.table(name).filter(_in_version(last[0] if last else {})).drop("part", "batch_id")
