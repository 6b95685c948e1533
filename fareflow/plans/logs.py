"""Logs about the layers and about runs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import local_now, run_id
from ..schema import PIPELINE_LOG, RUN_LOG
from ..sources import Layers

_COUNTS = ("ProcessedRecordCount", "InvalidAnomalyCount", "DuplicateCount")


def _counts(silver: DataFrame, errors: DataFrame, duplicates: DataFrame) -> DataFrame:
    """One row with the row count of each layer: three one-row counts, stacked and added up."""
    frames = zip(_COUNTS, (silver, errors, duplicates))
    counted = [frame.agg(F.count(F.lit(1)).alias(name)) for name, frame in frames]
    stacked = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), counted)
    # A count from footers gives no row where there is no file.
    return stacked.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in _COUNTS])


def pipeline_log(
    silver: DataFrame,
    errors: DataFrame,
    duplicates: DataFrame,
    status: str = "SUCCESS",
    file_name: str = "N/A",
    id_style: str = "epoch",
) -> DataFrame:
    """One row of counts over the stored layers, with run id and local time."""
    tagged = _counts(silver, errors, duplicates).withColumns(
        {
            "RunId": run_id(style=id_style),
            "Timestamp": local_now(),
            "Status": F.lit(status),
            "FileName": F.lit(file_name),
        }
    )
    return tagged.select(*PIPELINE_LOG.names)


def stored_log(layers: Layers, status: str = "SUCCESS", file_name: str = "N/A", id_style: str = "epoch") -> DataFrame:
    """``pipeline_log`` over the stored layers, counted from the footers of their files: no row is read."""
    stored = [layers.footers(table) for table in ("silver_trips", "error_log", "duplicate_log")]
    return pipeline_log(*stored, status, file_name, id_style)


def append_layer_counts(layers: Layers, status: str = "SUCCESS", file_name: str = "N/A") -> None:
    """Append the current layer counts to the log; if that fails, try once more as a FAILED row."""

    def append(as_status: str) -> None:
        counts = stored_log(layers, as_status, file_name, id_style="stamp")
        layers.append(counts, "layer_counts")

    layers.create("layer_counts")
    try:
        append(status)
    except Exception:
        append("FAILED")


def tracked_run(
    layers: Layers,
    pipeline_id: str,
    update_id: str,
    work: Callable[[], object],
) -> str:
    """Run ``work`` and append its start, end, status and error text to the run log.

    An error is logged as FAILED and not raised again; the status is returned.
    """
    spark = layers.spark
    # The id and start are fixed before the work begins: one literal row, read once.
    started = spark.range(1).select(run_id("RUN-").alias("RunId"), local_now().alias("StartTimeIST")).first()
    try:
        work()
        status, message = "SUCCESS", None
    except Exception as error:
        status, message = "FAILED", str(error) or "Unknown error"
    layers.create("run_log")
    layers.append(run_row(spark, started, pipeline_id, update_id, status, message), "run_log")
    return status


def run_row(spark: SparkSession, started, pipeline_id: str, update_id: str, status: str, message: str | None):
    """The one-row frame of a finished run; its end is the time of writing."""
    values = (started.RunId, pipeline_id, update_id, status, started.StartTimeIST, None, message)
    return spark.createDataFrame([values], RUN_LOG).withColumn("EndTimeIST", local_now())
