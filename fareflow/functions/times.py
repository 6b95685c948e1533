"""Trip times, the local clock and run ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import LOCAL_ZONE, TIME_PATTERN


def local_time(utc: Column) -> Column:
    """Wall clock of the reporting zone for a UTC instant."""
    return F.from_utc_timestamp(utc, LOCAL_ZONE)


def local_now() -> Column:
    """Local wall clock now; one value per query or micro-batch."""
    return local_time(F.current_timestamp())


def parse_trip_time(text: Column) -> Column:
    """UTC trip time text as a local timestamp; text in any other form gives null."""
    return local_time(F.try_to_timestamp(text, F.lit(TIME_PATTERN)))


def trip_times(trips: DataFrame) -> DataFrame:
    """Replace both trip time texts by local timestamps."""
    return trips.withColumns(
        {name: parse_trip_time(F.col(name)) for name in ("pickup_datetime", "dropoff_datetime")}
    )


def run_id(prefix: str = "Run-", style: str = "epoch", now: Column | None = None) -> Column:
    """Run id from the clock: ``epoch`` gives seconds, ``stamp`` gives yyyyMMdd_HHmmss_ffffff."""
    now = F.current_timestamp() if now is None else now
    tails = {
        "epoch": F.unix_timestamp(now).cast("string"),
        "stamp": F.date_format(now, "yyyyMMdd_HHmmss_SSSSSS"),
    }
    return F.concat(F.lit(prefix), tails[style])
