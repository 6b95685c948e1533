"""Trip files with headers of their own: columns in any order, unknown ones, and lines that do not fit.

Each file of a stream is read by its own header line. A known column gets its value wherever it stands; values of other
columns go to a map by name, and a line with more or fewer fields than its header is kept as a whole beside the fields that
it has. So nothing of a file is lost, and no column has to be known beforehand.

A line is a record: quoted fields may hold commas and doubled quotes, but no line ends. Blank lines are passed over. If a header
names a column twice, the first one counts for a known column and the last one for others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import local_now
from ..schema import ARRIVAL, MALFORMED, RAW
from .files import MAX_FILE_AGE

# Files of one batch, unless the caller says otherwise. Their headers are sent to every task.
FILES = 1000


def stream_lines(spark: SparkSession, path: str, **options: str | int) -> DataFrame:
    """The lines of all files of a folder as a stream, with their file and where their part of it begins."""
    lines = spark.readStream.options(**{"maxFileAge": MAX_FILE_AGE, "maxFilesPerTrigger": FILES} | options).text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"))


def _width(line: Column) -> Column:
    """Fields of a line: commas outside of quotes, and one."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _fields(line: Column, width: int) -> Column:
    names = [f"c{i}" for i in range(width)]
    parsed = F.from_csv(line, F.lit(", ".join(f"{name} string" for name in names)), {"escape": '"'})
    # The parsed line is a variable, so that it is parsed once for all fields.
    return F.transform(F.array(parsed), lambda row: F.array(*[row[name] for name in names]))[0]


def with_rescued(lines: DataFrame, now: Column | None = None) -> DataFrame:
    """Trips from the lines of a batch: known columns as text, ``rescued``, the line if it does not fit, file and arrival."""
    lines = lines.filter(F.length(F.trim("value")) > 0).withColumn("at", F.monotonically_increasing_id())
    # The part of a file that begins at 0 lies in one task, in order.
    headers = lines.filter("begin = 0").groupBy("file").agg(F.min("at").alias("head"), F.min_by("value", "at").alias("header"))
    headers = headers.withColumn("width", _width(F.col("header")))
    most = headers.agg(F.max("width")).first()[0] or 1
    headers = headers.withColumn("names", F.transform(F.slice(_fields(F.col("header"), most), 1, F.col("width")), lambda x: F.trim(x)))
    joined = lines.join(F.broadcast(headers.drop("header")), "file").filter(F.col("at") != F.col("head"))
    rows = joined.withColumns({"values": _fields(F.col("value"), most), "fields": _width(F.col("value"))})
    known = F.array(*[F.lit(name) for name in RAW.names])
    # A header may lack a column: its place is then 0, and there is no such value.
    typed = [F.get("values", (F.array_position("names", name) - 1).cast("int")).alias(name) for name in RAW.names]
    pairs = F.arrays_zip("names", F.slice(F.col("values"), 1, F.col("width")).alias("values"))
    others = F.filter(pairs, lambda x: x["names"].isNotNull() & x["values"].isNotNull() & ~F.array_contains(known, x["names"]))
    # The last of equal names counts.
    last = F.aggregate(
        others, F.create_map().cast("map<string,string>"),
        lambda held, x: F.map_concat(F.map_filter(held, lambda name, _: name != x["names"]), F.create_map(x["names"], x["values"])),
    )
    return rows.select(
        *typed,
        last.alias("rescued"),
        F.when(F.col("fields") != F.col("width"), F.col("value")).alias(MALFORMED),
        F.col("file").alias("source_file"),
        (local_now() if now is None else now).alias(ARRIVAL),
    )


def file_ledger(rescued: DataFrame) -> DataFrame:
    """Per source file: trips read from it, how many lines did not fit, and how many had values of unknown columns."""
    return rescued.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count(MALFORMED).alias("malformed"),
        F.count_if(F.size("rescued") > 0).alias("with_rescued"),
    )
