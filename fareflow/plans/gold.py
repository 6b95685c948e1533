"""Aggregate tables over the cleaned layer.

All of these add up per input split before the shuffle, so a frequent zone, hour or driver costs
one row per split. The same functions run on a stream, in complete mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import local_now


def _stamped(rows: DataFrame) -> DataFrame:
    return rows.withColumn("processing_timestamp", local_now())


def zone_revenue(silver: DataFrame) -> DataFrame:
    """Revenue, trip count and averages per pickup and drop-off zone."""
    by_zones = silver.groupBy("pickup_zone", "dropoff_zone", "zone_id")
    return _stamped(
        by_zones.agg(
            F.sum("total_amount").alias("total_revenue"),
            F.count("trip_id").alias("trip_count"),
            F.avg("fare_amount").alias("avg_fare"),
            F.avg("trip_duration").alias("avg_duration"),
            F.avg("trip_distance").alias("avg_distance"),
        )
    )


def peak_hours(silver: DataFrame) -> DataFrame:
    """Trips per local pickup hour; trips without a pickup time form the null hour."""
    hourly = silver.groupBy(F.hour("pickup_datetime").alias("pickup_hour"))
    return _stamped(hourly.agg(F.count("trip_id").alias("trips")))


def zone_sums(silver: DataFrame) -> DataFrame:
    """What a batch of the cleaned layer adds to ``zone_revenue``."""
    sums = [F.sum("total_amount").alias("total_revenue"), F.count("trip_id").alias("trip_count")]
    for name, column in (("fare", "fare_amount"), ("duration", "trip_duration"), ("distance", "trip_distance")):
        sums += [F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n")]
    return silver.groupBy("pickup_zone", "dropoff_zone", "zone_id").agg(*sums)


def hour_sums(silver: DataFrame) -> DataFrame:
    """What a batch adds to ``peak_hours``."""
    return peak_hours(silver).drop("processing_timestamp")


def driver_sums(silver: DataFrame) -> DataFrame:
    """What a batch adds to ``driver_performance``."""
    sums = F.sum("total_amount").alias("total_sum"), F.count("total_amount").alias("total_n")
    return silver.groupBy("driver_id").agg(*sums, F.count("trip_id").alias("total_trips"))


def _mean(total: str, number: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(number))


def zone_revenue_of(sums: DataFrame) -> DataFrame:
    """``zone_revenue`` from the sums of all batches."""
    return _stamped(
        sums.groupBy("pickup_zone", "dropoff_zone", "zone_id").agg(
            F.sum("total_revenue").alias("total_revenue"),
            F.sum("trip_count").alias("trip_count"),
            _mean("fare_sum", "fare_n").alias("avg_fare"),
            _mean("duration_sum", "duration_n").alias("avg_duration"),
            _mean("distance_sum", "distance_n").alias("avg_distance"),
        )
    )


def peak_hours_of(sums: DataFrame) -> DataFrame:
    """``peak_hours`` from the sums of all batches."""
    return _stamped(sums.groupBy("pickup_hour").agg(F.sum("trips").alias("trips")))


def driver_performance_of(sums: DataFrame) -> DataFrame:
    """``driver_performance`` from the sums of all batches."""
    means = _mean("total_sum", "total_n").alias("avg_fare")
    return _stamped(sums.groupBy("driver_id").agg(means, F.sum("total_trips").alias("total_trips")))


def peak_hours_text(silver: DataFrame) -> DataFrame:
    """Trips per local pickup hour as two-digit text."""
    hourly = silver.groupBy(F.date_format("pickup_datetime", "HH").alias("pickup_hour"))
    return _stamped(hourly.agg(F.count("trip_id").alias("trips")))


def driver_performance(silver: DataFrame) -> DataFrame:
    """Trips and average *total* per driver; ``avg_fare`` here is not the average of ``fare_amount``."""
    by_driver = silver.groupBy("driver_id")
    return _stamped(
        by_driver.agg(F.avg("total_amount").alias("avg_fare"), F.count("trip_id").alias("total_trips"))
    )
