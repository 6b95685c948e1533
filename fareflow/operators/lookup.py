"""Zone lookup and the join that adds it to trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import ZONE_LOOKUP, ZONES

def zone_lookup(spark: SparkSession) -> DataFrame:
    """The fixed zone table."""
    return spark.createDataFrame(ZONES, ZONE_LOOKUP)


def checked_lookup(lookup: DataFrame) -> DataFrame:
    """A caller's lookup once it is known to hold each name once; with repeats, trips would multiply.

    This runs a job, so stages call it once at their start and not in every batch.
    """
    names = lookup.filter(F.col("zone_name").isNotNull()).groupBy("zone_name").count()
    if not names.filter("count > 1").isEmpty():
        raise ValueError("zone lookup has repeated names")
    return lookup


def enrich_zone(trips: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Add ``zone_name`` and ``zone_id`` by pickup zone; trips without a match keep nulls.

    The fixed table of a few rows is broadcast. A lookup given by the caller has unique names (see
    ``checked_lookup``); Spark chooses how to join it by its size. Starts no job.
    """
    if lookup is None:
        zones = F.broadcast(zone_lookup(trips.sparkSession))
    else:
        zones = lookup.select("zone_name", "zone_id").filter(F.col("zone_name").isNotNull())
    return trips.join(zones, trips["pickup_zone"] == zones["zone_name"], "left")
