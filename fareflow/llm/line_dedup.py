"""Line dedup (operator 13): lines that several documents share go from all but one of them.

A text is cut at line feeds. The key of a line is the line without ASCII white space at its ends, in lower case (A-Z
only). Keys are hashed, and the hashes are range-partitioned and sorted, by document and then by place: a stream in
which the first line of each key and document stands out. First occurrences are counted; a key of ``min_chars`` code
points or more that at least ``min_docs`` documents hold loses its lines in all documents but those of the largest id.

No text is shuffled for this. What comes out is a bitmap for each document that loses something: words of 64 lines
with a bit for each line that stays, where words of which every line stays are left out. ``kept_texts`` applies them.

A line that a third of all documents hold is spread over as many partitions as its documents fill, since documents are
part of the range; the counts of its pieces are added up per key. So joins are by partition and key, of bounded size.

Keys are told apart by two independent 64-bit hashes. A missing or empty text is one empty line. Each row is a document
of its own, told apart by its place in the table: ids may be missing or repeat. A missing id is below all others; rows
that share the largest id of a key keep their lines. All copies of a line within a document go or stay together. An
empty table gives no rows; columns other than id and text are not read. Built-in functions only.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder
from .common import ROW, row_keys

# Fixed value: white space.
WHITE = " \t\n\x0b\x0c\r"
_KEY = ["h1", "h2"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_table(docs: DataFrame, min_chars: int) -> DataFrame:
    """The sorted stream of long lines: hashes, id, document, place, ``part`` and whether the document has the key ``first`` here.

    Kept as a table in the shared folder, so that what a lost executor held is read again, and parts stay the same.
    """
    lines = docs.select(*ROW, "id", F.posexplode(_lines(F.col("text"))).alias("at", "line"))
    bare = F.btrim("line", F.lit(WHITE))
    key = F.translate(bare, ascii_uppercase, ascii_lowercase)
    # The seed of the second hash is another one, so it tells apart what the first does not.
    hashed = lines.filter(F.length(bare) >= min_chars).select(
        F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(13), key).alias("h2"), "id", *ROW, "at"
    )
    document = [*_KEY, "id", *ROW]
    stream = hashed.repartitionByRange(*document).sortWithinPartitions(*document, "at")
    first = F.row_number().over(Window.partitionBy(*document).orderBy("at")) == 1
    path = f"{shared_folder(docs.sparkSession)}/lines"
    stream.withColumn("first", first).withColumn("part", F.spark_partition_id()).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def keep_bitmaps(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document that loses lines: its place, ``n_dropped`` and ``bitmap``, an array of (word, keep) by word.

    Line ``i`` of a document stays unless its bitmap holds word ``i div 64`` with bit ``i % 64`` off.
    """
    base = row_keys(docs).select(*ROW, F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    lines = line_table(base, min_chars)
    shared = (
        lines.filter("first")
        .groupBy(*_KEY)
        .agg(F.count("*").alias("docs"), F.max("id").alias("top"), F.min("part").alias("low"), F.max("part").alias("high"))
        .filter(F.col("docs") >= min_docs)
        # A key fills neighbouring parts.
        .select(*_KEY, "top", F.explode(F.sequence("low", "high")).alias("part"))
    )
    dropped = lines.join(shared, ["part", *_KEY]).filter(~F.col("id").eqNullSafe(F.col("top"))).select(*ROW, "at")
    bit = F.expr("shiftleft(1L, at & 63)")
    words = dropped.groupBy(*ROW, F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("off"))
    return words.groupBy(*ROW).agg(
        F.sum(F.bit_count("off")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("off").alias("keep")))).alias("bitmap"),
    )


def _off(bitmap: Column) -> Column:
    """Places of the lines that a bitmap drops."""
    bits = F.sequence(F.lit(0), F.lit(63))
    return F.flatten(
        F.transform(bitmap, lambda w: F.transform(F.filter(bits, lambda b: F.getbit(w["keep"], b) == 0), lambda b: w["word"] * 64 + b))
    )


def kept_texts(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its place, the id, ``n_lines`` (before), ``n_dropped`` and ``text``, the lines that stay."""
    base = row_keys(docs).select(*ROW, F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = base.join(bitmaps, ROW, "left")
    # Lambdas see the lines as a variable; a plain expression in their place would be worked out for each line.
    kept = lambda lines: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), _off(F.col("bitmap"))), lambda i: F.get(lines, i)), "\n"
    )
    text = F.transform(F.array(_lines(F.col("text"))), kept)[0]
    return rows.select(
        *ROW,
        F.col("id").alias(id_col),
        F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("bitmap").isNull(), F.col("text")).otherwise(text).alias("text"),
    )


def dedup_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``kept_texts`` by the bitmaps of the same documents."""
    docs = row_keys(docs)
    return kept_texts(docs, keep_bitmaps(docs, min_chars, min_docs, id_col, text_col), id_col, text_col)
