"""Trip files: CSV with a header line, every field read as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import local_now
from ..schema import ARRIVAL, MALFORMED, RAW


MAX_FILE_AGE = "36500d"


def csv_schema(spark: SparkSession, path: str) -> T.StructType:
    """All-text schema from the header line, for files with more columns or another column order."""
    return spark.read.option("header", True).csv(path).schema


def _configured(reader, schema: T.StructType, keep_malformed: bool):
    if keep_malformed:
        schema = T.StructType(schema.fields + [T.StructField(MALFORMED, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    # Columns are taken by position, so a header that does not fit the schema has to fail.
    return reader.schema(schema).option("header", True).option("enforceSchema", False)


def with_arrival(trips: DataFrame, now: Column | None = None) -> DataFrame:
    """Add the file of origin and the local arrival time; ``now`` replaces the clock."""
    return trips.withColumns(
        {"source_file": F.col("_metadata.file_path"), ARRIVAL: local_now() if now is None else now}
    )


def read_trips(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW,
    keep_malformed: bool = False,
    now: Column | None = None,
) -> DataFrame:
    """Trip files as a batch."""
    return with_arrival(_configured(spark.read, schema, keep_malformed).csv(path), now)


def stream_trips(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW,
    keep_malformed: bool = False,
    now: Column | None = None,
    **options: str | int,
) -> DataFrame:
    """Trip files as a stream over a folder; ``options`` are file-source options such as maxFilesPerTrigger.

    Left alone, Spark passes over files that are a week older than the newest one it has seen. Copies and late
    deliveries may keep an old date, so here only files older than ``MAX_FILE_AGE`` before the newest are passed
    over. The source remembers each file taken in for that long; where that list gets too long, move
    files away once they are taken in (``cleanSource="archive"`` with ``sourceArchiveDir``) or give a shorter
    ``maxFileAge``.
    """
    reader = spark.readStream.options(**{"maxFileAge": MAX_FILE_AGE} | options)
    return with_arrival(_configured(reader, schema, keep_malformed).csv(path), now)
