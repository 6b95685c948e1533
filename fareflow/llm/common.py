"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import math
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import shared_folder

# Rows that one step of a Python loop holds at once; texts may be long.
SLICE_ROWS = 256
# Bytes of rows that go to a worker at once; a longer row goes alone.
BATCH_BYTES = 4 << 20
# Partial counts that one task adds up.
FAN_IN = 16
# Counts that are copied at once.
COUNTS_AT_ONCE = 1 << 16


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows are computed once and kept in the folder that all executors share.

    Spark removes the files when the frame is no longer in use, if its cleaner is told to.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def map_rows(
    df: DataFrame,
    schema: str,
    rows: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]],
    kept: Callable[[], None] | None = None,
) -> DataFrame:
    """Run ``rows`` over each partition. It gets slices as lists by column and yields such lists.

    Slices are small, so that a worker holds few texts at once, and the session's Arrow batches are held to
    ``BATCH_BYTES``. ``kept`` is called after each partition, to empty what was kept for speed: workers live
    on, and later stages need their memory. Without it, ``rows`` keeps nothing, or what it keeps is bounded and meant to
    stay.
    """
    _bound_batches(df.sparkSession)
    kind = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(kind)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slices() -> Iterator[dict[str, list]]:
            for part in parts:
                for start in range(0, part.num_rows, SLICE_ROWS):
                    yield part.slice(start, SLICE_ROWS).to_pydict()

        for columns in rows(slices()):
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)
        if kept:
            kept()
            gc.collect()
        _release()

    return df.mapInArrow(batches, kind)


def _bound_batches(spark: SparkSession) -> None:
    """Spark's own limit is a number of rows, which may be of any length. A smaller limit, given in bytes, is left alone."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(setting).rstrip("b")
    if not held.isdigit() or int(held) > BATCH_BYTES:
        spark.conf.set(setting, str(BATCH_BYTES))


def _release() -> None:
    """Give free memory of this worker back to the system; allocators would keep it for as long as the worker lives."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def tree_sum(
    df: DataFrame, shape: tuple[int, ...], count: Callable[[Iterator[dict[str, list]], np.ndarray], None], kept: Callable[[], None] | None = None
) -> np.ndarray:
    """Counts of a fixed size over all rows. ``count`` adds the rows of a partition to an array.

    Partial counts are kept in the shared folder and added up ``FAN_IN`` at a time; only the last one comes to
    the driver. Counts stay at the largest 32-bit number once they get there.
    """

    def packed(counts: np.ndarray) -> dict[str, list]:
        # Bit by bit: whole copies would take several times the memory of the counts.
        pack, flat = zlib.compressobj(1), counts.reshape(-1)
        pieces = [pack.compress(flat[at : at + COUNTS_AT_ONCE].tobytes()) for at in range(0, flat.size, COUNTS_AT_ONCE)]
        return {"counts": [b"".join(pieces) + pack.flush()]}

    def unpacked(data: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(data), np.uint32).reshape(shape)

    def leaves(slices: Iterator[dict]) -> Iterator[dict]:
        counts = np.zeros(shape, np.uint32)
        count(slices, counts)
        if counts.any():
            yield packed(counts)

    def add(slices: Iterator[dict]) -> Iterator[dict]:
        total = None
        for part in slices:
            for data in part["counts"]:
                if total is None:
                    total = unpacked(data).copy()
                    continue
                flat, more = total.reshape(-1), unpacked(data).reshape(-1)
                for at in range(0, flat.size, COUNTS_AT_ONCE):
                    step = slice(at, at + COUNTS_AT_ONCE)
                    flat[step] = np.minimum(flat[step].astype(np.uint64) + more[step], 0xFFFFFFFF)
        if total is not None:
            yield packed(total)

    partial = checkpointed(map_rows(df, "counts binary", leaves, kept))
    while (parts := partial.rdd.getNumPartitions()) > 1:
        partial = checkpointed(map_rows(partial.coalesce(math.ceil(parts / FAN_IN)), "counts binary", add))
    last = partial.first()
    return unpacked(bytes(last[0])) if last else np.zeros(shape, np.uint32)


# Names of the columns that tell rows apart, and the mark by which they are known from a caller's own columns.
ROW = ["__file", "__row"]
_MARK = {"fareflow_row_key": True}


def row_keys(df: DataFrame) -> DataFrame:
    """Add ``__file`` and ``__row``, which tell rows apart even where their ids repeat or are missing.

    A frame that comes from here keeps its keys, known by a mark in the schema; a caller's own columns of these
    names are replaced. Stored tables have such a key of their own, which is the same on every scan. Other frames
    are kept first, because what they compute could come in another order the next time.
    """
    from pyspark.errors import AnalysisException

    if all(name in df.columns and df.schema[name].metadata == _MARK for name in ROW):
        return df
    marked = {name: F.col(name).alias(name, metadata=_MARK) for name in ROW}
    try:
        return df.withColumns({"__file": F.xxhash64("_metadata.file_path"), "__row": F.col("_metadata.row_index")}).withColumns(marked)
    except AnalysisException:
        kept = checkpointed(df.withColumns({"__file": F.lit(0).cast("long"), "__row": F.monotonically_increasing_id()}))
        return kept.withColumns(marked)


# Rows of keys, 16 bytes or so each, that are still sent to every task; beyond it rows are shuffled to their keys.
KEY_ROWS = 1_000_000


def restrict(df: DataFrame, keys: DataFrame, on: list[str], keep: bool) -> DataFrame:
    """The rows of ``df`` whose key is in ``keys`` (with its other columns), or is not; ``keys`` has each key once."""
    if keys.limit(KEY_ROWS + 1).count() <= KEY_ROWS:
        keys = F.broadcast(keys)
    return df.join(keys, on, "inner" if keep else "left_anti")


def dense(df: DataFrame, column: str) -> DataFrame:
    """Close the gaps of a stored ``monotonically_increasing_id``: numbers from 0, in the same order."""
    sizes = df.groupBy(F.shiftright(column, 33).alias("__part")).agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each partition.
    sizes = sizes.select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    rows = df.withColumn("__part", F.shiftright(column, 33)).join(F.broadcast(sizes), "__part")
    return rows.withColumn(column, F.col(column) - F.shiftleft("__part", 33) + F.col("__before")).drop("__part", "__before")


def numbered(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Number the rows of a frame from 0 by ``order``, by a range sort and the sizes of its partitions."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(out, F.monotonically_increasing_id())
    return dense(checkpointed(rows), out)
