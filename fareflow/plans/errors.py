"""Logs of rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import local_now, parse_trip_time, sanitize_numeric, trip_metrics, trip_times
from ..operators import copy_order, first_copies, later_copies
from ..schema import KEY, MALFORMED, MAX_DURATION, MAX_SPEED
from ..sources.layers import quoted


def _snapshot(rows: DataFrame) -> Column:
    """The whole row, with trip times still as text."""
    return F.struct(*[F.col(quoted(name)).alias(name) for name in rows.columns])


def _entry(applies: Column, reason: Column, category: str) -> Column:
    return F.when(applies, F.struct(reason.alias("error_reason"), F.lit(category).alias("error_category")))


def category_counts(errors: DataFrame) -> DataFrame:
    """Log rows per category."""
    return errors.groupBy("error_category").agg(F.count(F.lit(1)).alias("rows"))


def error_log(bronze: DataFrame, on_null: str = "keep") -> DataFrame:
    """INVALID rows (speed or duration over the limit) and ANOMALY rows (no trip id).

    With ``on_null="drop"``, rows that the cleaned layer drops because speed or duration is unknown are INVALID too.

    A row that is both is logged twice. The log is the union of the two kinds, read in one pass:
    each bad row carries up to two entries, which are then unpacked. An ANOMALY entry has no
    duration or speed. Works on streams as it keeps no state.
    """
    rows = sanitize_numeric(bronze.drop(MALFORMED))
    columns = rows.columns
    checked = trip_metrics(trip_times(rows.withColumn("row_data", _snapshot(rows))))
    too_fast = F.coalesce(F.col("speed") > MAX_SPEED, F.lit(False))
    too_long = F.coalesce(F.col("trip_duration") > MAX_DURATION, F.lit(False))
    unknown = F.lit(on_null == "drop") & (F.col("speed").isNull() | F.col("trip_duration").isNull())
    no_id = F.col(KEY).isNull()
    entries = F.array(
        _entry(
            too_fast | too_long | unknown,
            F.when(too_fast, F.lit("Invalid Speed"))
            .when(too_long, F.lit("Invalid Duration"))
            .otherwise(F.lit("Unknown Speed or Duration")),
            "INVALID",
        ),
        _entry(no_id, F.lit("Missing trip_id"), "ANOMALY"),
    )
    # The filter reads what the unpacking gives out, so Spark cannot move it below the time parsing
    # and do that part twice.
    logged = checked.withColumn("_entry", F.explode(entries)).filter(F.col("_entry").isNotNull())
    measured = F.col("_entry.error_category") == "INVALID"
    return logged.select(
        *map(quoted, columns),
        F.when(measured, F.col("trip_duration")).alias("trip_duration"),
        F.when(measured, F.col("speed")).alias("speed"),
        "_entry.error_reason",
        "_entry.error_category",
        "row_data",
        local_now().alias("error_timestamp"),
    )


_TEXTS = ("pickup_datetime", "dropoff_datetime")


def instants() -> dict[str, Column]:
    """Trip times beside their text."""
    return {f"_{name}": parse_trip_time(F.col(name)) for name in _TEXTS}


def batch_firsts_order(rows: DataFrame) -> list[str]:
    """The order that the cleaned layer uses: times count as instants; their text only breaks ties."""
    return [f"_{name[1:-1]}" if name[1:-1] in _TEXTS else name for name in copy_order(rows)] + list(_TEXTS)


def batch_firsts(bronze: DataFrame) -> DataFrame:
    """The first copy of each id, as typed rows with trip times both as text and, beside it, as instants."""
    rows = sanitize_numeric(bronze.drop(MALFORMED))
    return first_copies(rows.withColumns(instants()), order=batch_firsts_order(rows))


def prepared_firsts(firsts: DataFrame) -> DataFrame:
    """The same rows as ``prepare`` gives them."""
    return firsts.withColumns({name: F.col(f"_{name}") for name in _TEXTS}).drop(*instants())


def duplicate_log(bronze: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Every copy of a trip id but the first, in the order that the cleaned layer uses.

    For a batch, ``known`` holds those of its ``batch_firsts`` whose id batches before it have taken in: these are later
    copies too.
    """
    rows = sanitize_numeric(bronze.drop(MALFORMED))
    copies = later_copies(rows, order=batch_firsts_order(rows), computed=instants())
    if known is not None:
        copies = copies.unionByName(known.select(*map(quoted, rows.columns)))
    return duplicate_rows(copies)


def duplicate_rows(copies: DataFrame) -> DataFrame:
    """Typed rows that are later copies, as entries of the log."""
    return copies.withColumns(
        {
            "error_reason": F.lit("Duplicate trip_id"),
            "error_category": F.lit("DUPLICATE"),
            "row_data": _snapshot(copies),
            "error_timestamp": local_now(),
        }
    )
