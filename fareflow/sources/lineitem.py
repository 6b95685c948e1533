"""Raw trips derived from the ``lineitem`` table, with gaps, bad text and repeats as trip files have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ARRIVAL, TIME_PATTERN

# Pickup and drop-off zones by remainder of six; the last has no entry in the lookup.
_ZONE_NAMES = ["Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island", "EWR"]


def _zone(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in _ZONE_NAMES]), (number % 6 + 1).cast("int"))


def _after(start: Column, minutes: Column) -> Column:
    return start + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0))


def _blank_every(step: int, otherwise: Column, text: str | None = None) -> Column:
    return F.when(F.col("l_partkey") % step == 0, F.lit(text)).otherwise(otherwise)


def raw_trips(lineitem: DataFrame) -> DataFrame:
    """One raw trip per line item: the columns of the raw layer. Works on batches and streams."""
    part, supplier, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    extra = part % 1440
    ride = (part * 7 + supplier * 13 + line) % 200 - 5
    start = _after(F.col("l_shipdate").cast("timestamp"), extra)
    end = _after(F.col("l_shipdate").cast("timestamp"), extra + ride)
    price, tip = F.col("l_extendedprice"), F.col("l_discount") * 100
    total = F.when(F.col("l_returnflag") == "R", price * 0.99).when(F.col("l_returnflag") == "A", price + tip)
    trip = F.concat(F.lit("T"), F.col("l_orderkey"), F.lit("-"), line)
    return lineitem.select(
        _blank_every(97, trip).alias("trip_id"),
        F.concat(F.lit("D"), supplier).alias("driver_id"),
        _blank_every(211, (line % 6 + 1).cast("string"), "x").alias("passenger_count"),
        _blank_every(301, F.date_format(start, TIME_PATTERN), "bad-date").alias("pickup_datetime"),
        F.date_format(end, TIME_PATTERN).alias("dropoff_datetime"),
        _zone(supplier).alias("pickup_zone"),
        _zone(part).alias("dropoff_zone"),
        _blank_every(89, F.col("l_quantity").cast("bigint").cast("string"), "n/a").alias("trip_distance"),
        price.alias("fare_amount"),
        tip.alias("tip_amount"),
        total.alias("total_amount"),
        F.lit("lineitem").alias("source_file"),
        start.alias(ARRIVAL),
    )


def stream_table(spark: SparkSession, folder: str, table: str, schema: T.StructType, **options) -> DataFrame:
    """A test table as a stream. The glob lets one path stand for a file or a folder of files."""
    path = f"{folder.rstrip('/')}/[{table[0]}]{table[1:]}.parquet"
    return spark.readStream.schema(schema).options(**options).parquet(path)
