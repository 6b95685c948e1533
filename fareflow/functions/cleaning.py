"""Tolerant typing of text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _number(name: str) -> Column:
    return F.col(name).try_cast("double")


def _whole_number(name: str) -> Column:
    # By way of double, so that "1.0" reads as 1 instead of null.
    return _number(name).try_cast("int")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


# The columns that get a type, and the type.
_TYPED_BY = {
    "trip_distance": _number,
    "fare_amount": _number,
    "tip_amount": _number,
    "total_amount": _number,
    "passenger_count": _whole_number,
    "driver_id": _text,
}


def sanitize_numeric(trips: DataFrame) -> DataFrame:
    """Type the known columns that are present; text that does not parse becomes null."""
    present = set(trips.columns)
    return trips.withColumns({name: typed(name) for name, typed in _TYPED_BY.items() if name in present})
