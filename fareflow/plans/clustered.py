"""First and later copies over a raw layer that is stored by trip id.

Rows of an id lie in one bucket, so copies are ranked where they are read: there is no shuffle by id. An id with more than
``HOT_ROWS`` rows would make its bucket too large for a task, so its rows are dealt to slices, and buckets are by id and slice.
Copies are ranked within each slice, and only the first copy of each slice of such an id is shuffled, to find the first of all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sanitize_numeric
from ..schema import KEY, MALFORMED
from ..sources import Layers, without_metadata
from ..sources.layers import quoted
from .errors import batch_firsts_order, duplicate_rows, instants, prepared_firsts

BUCKETS = 32
HOT_ROWS = 1_000_000
_OWN = ("slice", "hot")


def store_by_id(layers: Layers, bronze: DataFrame, hot_rows: int = HOT_ROWS, buckets: int = BUCKETS) -> None:
    """Write raw rows in buckets by id and slice; each bucket is one file. Replaces what is stored."""
    name = layers.name("bronze_by_id")
    layers.database("bronze_by_id")
    sizes = bronze.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    # At most one id for every ``hot_rows`` rows; Spark measures them, and joins the rows without moving them while they are few.
    hot = sizes.select(F.col(KEY).alias("_id"), F.ceil(F.col("_n") / hot_rows).alias("_slices"))
    rows = bronze.join(hot, bronze[KEY] == hot["_id"], "left")
    everything = F.xxhash64(*[F.col(quoted(c)) for c in bronze.columns])
    rows = rows.withColumns({"slice": F.coalesce(F.pmod(everything, "_slices"), F.lit(0)).cast("int"), "hot": F.col("_id").isNotNull()})
    place = [KEY, "slice"]
    rows = without_metadata(rows.drop("_id", "_slices")).repartition(buckets, *place).sortWithinPartitions(*place)
    writer = rows.write.bucketBy(buckets, *place).sortBy(*place).mode("overwrite").option("path", layers.location("bronze_by_id"))
    writer.saveAsTable(name)


def _ranked(layers: Layers) -> tuple[DataFrame, DataFrame]:
    """Rows with an id, with ``_later``: ids in one slice and later copies within slices, and the first copies of slices of hot ids."""
    stored = sanitize_numeric(layers.spark.table(layers.name("bronze_by_id")).drop(MALFORMED)).filter(F.col(KEY).isNotNull())
    stored = stored.withColumns(instants())
    order = batch_firsts_order(stored.drop(*_OWN, *instants()))
    local = F.row_number().over(Window.partitionBy(KEY, "slice").orderBy(*order))
    # Hot rows are picked out by the scan, before they are ranked.
    firsts = stored.filter("hot").withColumn("_later", local > 1).filter("NOT _later")
    over_slices = F.row_number().over(Window.partitionBy(KEY).orderBy(*order))
    return stored.withColumn("_later", local > 1).filter("NOT hot OR _later"), firsts.withColumn("_later", over_slices > 1)


def stored_firsts(layers: Layers) -> DataFrame:
    """The first copy of each id, as ``prepare`` gives rows."""
    local, hot = _ranked(layers)
    rows = local.filter("NOT _later").unionByName(hot.filter("NOT _later"))
    return prepared_firsts(rows.drop("_later", *_OWN))


def stored_duplicates(layers: Layers) -> DataFrame:
    """The duplicate log over the stored raw layer."""
    local, hot = _ranked(layers)
    rows = local.filter("_later").unionByName(hot.filter("_later"))
    return duplicate_rows(rows.drop("_later", *_OWN, *instants()))
