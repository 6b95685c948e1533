"""Fields derived from one trip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trip_metrics(trips: DataFrame) -> DataFrame:
    """Add ``trip_duration`` in minutes and ``speed`` per hour; no speed without a positive duration."""
    seconds = F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime")
    timed = trips.withColumn("trip_duration", seconds / 60.0)
    hours = F.col("trip_duration") / 60.0
    return timed.withColumn("speed", F.when(F.col("trip_duration") > 0, F.col("trip_distance") / hours))


def revenue_fields(trips: DataFrame) -> DataFrame:
    """Fill a missing total from fare and tip, then flag totals that cover the fare."""
    total = F.coalesce(F.col("total_amount"), F.col("fare_amount") + F.col("tip_amount"))
    return trips.withColumn("total_amount", total).withColumn(
        "revenue_valid", F.coalesce(F.col("total_amount") >= F.col("fare_amount"), F.lit(False))
    )
