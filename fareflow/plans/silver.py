"""Cleaned layer: typed, timed, first copies only, enriched and checked trips."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import local_now, revenue_fields, sanitize_numeric, trip_metrics, trip_times
from ..operators import enrich_zone, expect_or_drop, first_copies
from ..schema import KEY, MALFORMED, RULES


def prepare(bronze: DataFrame) -> DataFrame:
    """Typed trips with a key. Times are parsed here, before any shuffle, as they get much narrower."""
    return trip_times(sanitize_numeric(bronze)).filter(F.col(KEY).isNotNull()).drop(MALFORMED)


def derive(trips: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Duration, speed, revenue fields and zone of prepared trips."""
    return enrich_zone(revenue_fields(trip_metrics(trips)), lookup).withColumn("processing_timestamp", local_now())


def silver_trips(
    bronze: DataFrame,
    lookup: DataFrame | None = None,
    rules: Mapping[str, str] = RULES,
    on_null: str = "keep",
    observed: Observation | str | None = None,
) -> DataFrame:
    """The cleaned layer. Rules apply after de-duplication, so a bad first copy hides later ones."""
    return expect_or_drop(derive(first_copies(prepare(bronze)), lookup), rules, on_null, observed)
