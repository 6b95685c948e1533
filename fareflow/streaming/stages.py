"""Stages: each one reads a stream, changes it and fills one table, with a checkpoint of its own.

A stage function starts a query that takes in all that has arrived and ends; ``finish`` waits for
it. Stages that do not feed each other can run side by side. Stages meet only at stored tables, so that each
query has at most one watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans import errors, gold
from ..plans.logs import stored_log
from ..sources import Layers, stream_lines, with_rescued, without_metadata
from ..sources.layers import COMPRESSION, replace_rows
from .exact import _store_batch, silver_stage
from .progress import follow


def finish(*queries: StreamingQuery) -> None:
    """Wait for running stages. If one fails, the others are stopped and its error is raised."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def append_stage(rows: DataFrame, layers: Layers, table: str) -> StreamingQuery:
    """Append a stream to a table, exactly once across restarts."""
    name = layers.create(table, rows.schema)
    return (
        without_metadata(rows)
        .writeStream.outputMode("append")
        .option("checkpointLocation", layers.checkpoint(table))
        .option("compression", COMPRESSION)
        .trigger(availableNow=True)
        .toTable(name)
    )


def bronze_stage(layers: Layers, trips: DataFrame) -> StreamingQuery:
    """Raw trips as they arrive."""
    return append_stage(trips, layers, "bronze_trips")


def rescued_stage(layers: Layers, path: str, now: Column | None = None, **options: str | int) -> StreamingQuery:
    """Raw trips of a folder whose files have headers of their own; what fits no column is kept beside them."""
    name = layers.create("bronze_rescued")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        _store_batch(with_rescued(batch, now), name, batch_id)

    return (
        stream_lines(layers.spark, path, **options)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", layers.checkpoint("bronze_rescued"))
        .trigger(availableNow=True)
        .start()
    )


def error_stage(layers: Layers, on_null: str = "keep", **options: str | int) -> StreamingQuery:
    """Log of invalid rows and rows without an id, next to the cleaned layer and from the same table."""
    rows = errors.error_log(layers.stream("bronze_trips", **options), on_null)
    return append_stage(rows, layers, "error_log")


# Aggregate tables and how each is computed, for streams and for batches.
GOLD: dict[str, Callable[[DataFrame], DataFrame]] = {
    "gold_zone_revenue": gold.zone_revenue,
    "gold_peak_hours": gold.peak_hours,
    "gold_driver_perf": gold.driver_performance,
}


def gold_stage(layers: Layers, table: str, **options: str | int) -> StreamingQuery:
    """Keep an aggregate over the cleaned layer and rewrite its table with every batch.

    There is no watermark, so groups stay open for good and the complete result is written. It is
    as small as the number of zone pairs, hours or drivers. This reads the files of the cleaned layer once each; where
    a batch of that layer may be replayed half-way, use ``gold_totals``, which counts nothing twice.
    """
    name, location = layers.create(table), layers.location(table)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        replace_rows(batch, name, location)

    return (
        GOLD[table](layers.stream("silver_trips", **options))
        .writeStream.outputMode("complete")
        .foreachBatch(write_batch)
        .option("checkpointLocation", layers.checkpoint(table))
        .trigger(availableNow=True)
        .start()
    )


# Aggregate tables, the sums they come from, and how.
TOTALS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "gold_zone_revenue": ("zone_sums", gold.zone_revenue_of),
    "gold_peak_hours": ("hour_sums", gold.peak_hours_of),
    "gold_driver_perf": ("driver_sums", gold.driver_performance_of),
}


def gold_totals(layers: Layers, table: str) -> None:
    """Rewrite an aggregate from the sums that each batch of the cleaned layer has stored.

    No state is kept, and a batch that ran again has replaced its own sums, so none counts twice.
    """
    sums, total = TOTALS[table]
    layers.create(table)
    layers.overwrite(total(layers.read(sums)), table)


def run_layers(
    layers: Layers, trips: DataFrame, lookup: DataFrame | None = None, on_null: str = "keep", **options: str | int
) -> None:
    """Bring all tables up to date with the raw stream ``trips``; ``options`` pace the stages that read it."""
    follow(layers, bronze_trips=bronze_stage(layers, trips))
    cleaned = silver_stage(layers, lookup=lookup, on_null=on_null, **options)
    follow(layers, silver_trips=cleaned, error_log=error_stage(layers, on_null, **options))
    for table in TOTALS:
        gold_totals(layers, table)
    layers.create("pipeline_log")
    layers.overwrite(stored_log(layers), "pipeline_log")
