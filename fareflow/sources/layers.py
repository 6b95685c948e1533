"""The tables of all layers: names, comments, properties, and how they are written and read."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S


# Of the files of all tables; a third smaller than Spark's usual one.
COMPRESSION = "zstd"


@dataclass(frozen=True)
class TableSpec:
    layer: str
    schema: T.StructType
    comment: str
    quality: str | None = None
    by_batch: bool = False
    # Columns that the table is partitioned by before the batch, and options of its files.
    parts: tuple[str, ...] = ()
    options: tuple[tuple[str, str], ...] = ()


TABLES = {
    "bronze_trips": TableSpec("bronze", S.BRONZE, "Raw trips with arrival time and source file", "bronze"),
    "bronze_by_id": TableSpec("bronze", S.BRONZE, "Raw trips in buckets by trip id", "bronze"),
    "bronze_rescued": TableSpec(
        "bronze", S.RESCUED, "Raw trips read by the header of their file, with what fits no column", "bronze", True
    ),
    "zone_lookup": TableSpec("silver", S.ZONE_LOOKUP, "Zones for enrichment"),
    "silver_trips": TableSpec("silver", S.SILVER, "Cleaned, checked and de-duplicated trips", "silver", True),
    "seen_ids": TableSpec(
        "silver", S.SEEN_IDS, "Trip ids that the cleaned layer has taken in", None, True,
        ("bucket",), (("parquet.bloom.filter.enabled#trip_id", "true"),),
    ),
    "error_log": TableSpec("error", S.ERROR_LOG, "Invalid rows and rows without an id", "error"),
    "duplicate_log": TableSpec("error", S.DUPLICATE_LOG, "Later copies of a trip id", None, True),
    "quality_log": TableSpec("error", S.QUALITY_LOG, "Rows read and rule violations of each batch", None, True),
    "zone_sums": TableSpec("gold", S.ZONE_SUMS, "Sums per zone pair and batch", None, True),
    "hour_sums": TableSpec("gold", S.HOUR_SUMS, "Trips per local hour and batch", None, True),
    "driver_sums": TableSpec("gold", S.DRIVER_SUMS, "Sums per driver and batch", None, True),
    "gold_zone_revenue": TableSpec("gold", S.GOLD_ZONE_REVENUE, "Revenue and averages per zone pair", "gold"),
    "gold_peak_hours": TableSpec("gold", S.GOLD_PEAK_HOURS, "Trips per local hour", "gold"),
    "gold_driver_perf": TableSpec("gold", S.GOLD_DRIVER_PERF, "Trips and average total per driver", "gold"),
    "zone_hours": TableSpec("gold", S.ZONE_HOURS, "Trips and revenue per pickup zone and closed hour", "gold"),
    "driver_totals": TableSpec("gold", S.DRIVER_TOTALS, "Running totals per driver", "gold", True, ("part",)),
    "driver_totals_commits": TableSpec("gold", S.KEYED_COMMITS, "Versions of the parts of driver_totals", None, True),
    "zone_totals": TableSpec("gold", S.ZONE_TOTALS, "Running totals per zone pair", "gold", True, ("part",)),
    "zone_totals_commits": TableSpec("gold", S.KEYED_COMMITS, "Versions of the parts of zone_totals", None, True),
    "progress_log": TableSpec("log", S.PROGRESS_LOG, "Batches of stages and how each stage ended"),
    "pipeline_log": TableSpec("log", S.PIPELINE_LOG, "Counts over the layers"),
    "layer_counts": TableSpec("log", S.PIPELINE_LOG, "Counts over the layers, one row per run"),
    "run_log": TableSpec("log", S.RUN_LOG, "Runs with start, end and status"),
}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _ddl(kind: T.DataType) -> str:
    """A type for SQL, with the names inside it quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"{quoted(f.name)}: {_ddl(f.dataType)}" for f in kind) + ">"
    return kind.simpleString()


def without_metadata(rows: DataFrame) -> DataFrame:
    """Drop column metadata. A stored watermark mark would make later streams wait for it in silence."""
    return rows.select([F.col(quoted(name)).alias(name, metadata={}) for name in rows.columns])


class Layers:
    """Parquet tables below one root folder, one database per layer."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = "fareflow"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix

    def name(self, table: str) -> str:
        return f"{self.prefix}_{TABLES[table].layer}.{table}"

    def location(self, table: str) -> str:
        return f"{self.root}/{TABLES[table].layer}/{table}"

    def checkpoint(self, stage: str) -> str:
        """Checkpoint of the stage that fills a table; it lives and dies with the table."""
        return f"{self.root}/checkpoints/{stage}"

    def database(self, table: str) -> None:
        """Create the database of a table if it is missing."""
        layer = TABLES[table].layer
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.prefix}_{layer} LOCATION '{self.root}/{layer}'")

    def create(self, table: str, columns: T.StructType | None = None) -> str:
        """Create the table if it is missing; ``columns`` replaces the usual ones, e.g. to pass more on."""
        spec = TABLES[table]
        self.database(table)
        wanted = columns or spec.schema
        ddl = ", ".join(f"{quoted(f.name)} {_ddl(f.dataType)}" for f in wanted)
        if spec.by_batch:
            ddl += ", batch_id bigint"
        parts = [f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({ddl}) USING parquet"]
        options = (("compression", COMPRESSION), *spec.options)
        parts.append("OPTIONS (" + ", ".join(f"'{name}' = '{value}'" for name, value in options) + ")")
        if partitions := [*spec.parts, *["batch_id"] * spec.by_batch]:
            parts.append(f"PARTITIONED BY ({', '.join(partitions)})")
        parts.append(f"COMMENT '{spec.comment}'")
        if spec.quality:
            parts.append(f"TBLPROPERTIES ('quality' = '{spec.quality}')")
        parts.append(f"LOCATION '{self.location(table)}'")
        self.spark.sql(" ".join(parts))
        self._widen(table, wanted)
        return self.name(table)

    def _widen(self, table: str, wanted: T.StructType) -> None:
        """Add columns that a stored table lacks; a column of another type stops the stage with its name."""
        stored = {f.name: f.dataType for f in self.spark.table(self._current(table)).schema}
        other = [f.name for f in wanted if f.name in stored and stored[f.name].simpleString() != f.dataType.simpleString()]
        if other:
            raise ValueError(f"{table} is stored with another type of {', '.join(other)}; rebuild it to go on")
        missing = [f"{quoted(f.name)} {_ddl(f.dataType)}" for f in wanted if f.name not in stored]
        if missing:
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({', '.join(missing)})")

    def _current(self, table: str) -> str:
        # Stages write from sessions of their own, so the file listing kept here may be old.
        name = self.name(table)
        self.spark.catalog.refreshTable(name)
        return name

    def read(self, table: str) -> DataFrame:
        rows = self.spark.read.table(self._current(table))
        return rows.drop("batch_id") if TABLES[table].by_batch else rows

    def footers(self, table: str) -> DataFrame:
        """A stored table whose rows can be counted from the footers of its files, without reading any of them.

        Spark does so for its newer kind of Parquet scan, which tables of the catalog do not get by themselves.
        """
        conf = self.spark.conf
        location = self.spark.sql(f"DESCRIBE FORMATTED {self._current(table)}").filter("col_name = 'Location'").first().data_type
        conf.set("spark.sql.parquet.aggregatePushdown", "true")
        older = conf.get("spark.sql.sources.useV1SourceList")
        conf.set("spark.sql.sources.useV1SourceList", ",".join(kind for kind in older.split(",") if kind != "parquet"))
        try:
            return self.spark.read.schema(self.spark.table(self.name(table)).schema).parquet(location)
        finally:
            conf.set("spark.sql.sources.useV1SourceList", older)

    def stream(self, table: str, **options: str | int) -> DataFrame:
        rows = self.spark.readStream.options(**options).table(self._current(table))
        return rows.drop("batch_id") if TABLES[table].by_batch else rows

    def append(self, rows: DataFrame, table: str) -> None:
        without_metadata(rows).write.mode("append").saveAsTable(self.name(table))

    def overwrite(self, rows: DataFrame, table: str) -> None:
        """Replace all rows but keep the comment and properties of the table.

        The rows are written to a new folder first, and the table then points there: readers see the old rows or
        the new ones, and a job that fails leaves the old ones. The rows before stay for readers that have begun; older
        ones are removed. Tables in partitions by batch belong to a stage, which replaces its own partitions.
        """
        if TABLES[table].by_batch:
            raise ValueError(f"{table} is kept by batch; its stage replaces the partitions of a batch")
        replace_rows(rows, self.name(table), self.location(table))


def replace_rows(rows: DataFrame, name: str, location: str) -> None:
    """Write ``rows``, matched by column name, to a new folder below ``location`` and switch the table to it."""
    session = rows.sparkSession
    before = session.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first().data_type
    folder = f"{location}_versions/{uuid.uuid4().hex}"
    columns = [quoted(column) for column in session.table(name).columns]
    without_metadata(rows.select(*columns)).write.parquet(folder)
    session.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    session.catalog.refreshTable(name)
    _keep_only(session, f"{location}_versions", {folder, before})


def _files(session: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    path = session._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(session._jsc.hadoopConfiguration()), path


def _keep_only(session: SparkSession, parent: str, kept: set[str]) -> None:
    """Remove the folders of versions that no table or reader needs any more."""
    files, path = _files(session, parent)
    names = {folder.rstrip("/").rsplit("/", 1)[-1] for folder in kept}
    for version in files.listStatus(path):
        if version.isDirectory() and version.getPath().getName() not in names:
            files.delete(version.getPath(), True)


def drop_partitions(session: SparkSession, name: str, **spec: int) -> None:
    """Drop the partitions of a table that have these values, and their files, which Spark leaves where they are."""
    wanted = ", ".join(f"{column} = {value}" for column, value in spec.items())
    dropped = [row[0] for row in session.sql(f"SHOW PARTITIONS {name} PARTITION ({wanted})").collect()]
    if not dropped:
        return
    session.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({wanted})")
    location = session.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first().data_type
    for partition in dropped:
        files, path = _files(session, f"{location}/{partition}")
        files.delete(path, True)
