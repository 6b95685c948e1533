"""Trips per zone and hour by event time: a consumer of the cleaned layer with a watermark on the pick-up time.

A window is stored once the watermark has passed its end, and its state is then dropped. Trips that come for a window that
is closed are late: they stay in the cleaned layer, but the stored window does not change. ``late_trips`` counts them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schema import WATERMARK_DELAY
from ..sources import Layers

EVENT_TIME = "pickup_datetime"
DURATION = "1 hour"


def _by_window(trips: DataFrame, duration: str, *aggregates: Column) -> DataFrame:
    grouped = trips.groupBy(F.window(EVENT_TIME, duration).alias("_window"), "pickup_zone").agg(*aggregates)
    return grouped.select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *grouped.columns[1:])


def zone_windows(trips: DataFrame, duration: str = DURATION) -> DataFrame:
    """Trips and revenue per pickup zone and window; trips without a pickup time are in none. For batches and streams."""
    trips_in, revenue = F.count("trip_id").alias("trips"), F.sum("total_amount").alias("total_revenue")
    return _by_window(trips, duration, trips_in, revenue)


def window_stage(layers: Layers, duration: str = DURATION, delay: str = WATERMARK_DELAY, **options: str | int) -> StreamingQuery:
    """Append windows of the cleaned layer that are closed, in event time."""
    from .stages import append_stage

    trips = layers.stream("silver_trips", **options).withWatermark(EVENT_TIME, delay)
    return append_stage(zone_windows(trips, duration), layers, "zone_hours")


def watermark(layers: Layers, stage: str = "zone_hours") -> Column:
    """How far a stage has come in event time, by the progress log; missing before its first batch with rows."""
    reached = layers.read("progress_log").filter(F.col("stage") == stage).agg(F.max("watermark")).first()[0]
    return F.lit(reached).cast("timestamp")


def late_trips(layers: Layers, duration: str = DURATION) -> DataFrame:
    """Trips that came after their window was closed, per window and zone, once the stage has read all of the layer.

    Of the trips of a closed window, those that the stored window does not count are late. A window that had only
    late trips is not stored; the watermark tells that it is closed.
    """
    whole = zone_windows(layers.read("silver_trips"), duration).filter(F.col("window_end") <= watermark(layers))
    counted = layers.read("zone_hours").select("window_start", "pickup_zone", F.col("trips").alias("_counted"))
    same = whole["window_start"].eqNullSafe(counted["window_start"]) & whole["pickup_zone"].eqNullSafe(counted["pickup_zone"])
    late = F.col("trips") - F.coalesce("_counted", F.lit(0))
    joined = whole.join(counted, same, "left").select(whole["window_start"], "window_end", whole["pickup_zone"], late.alias("late"))
    return joined.filter("late > 0")
