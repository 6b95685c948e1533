"""Progress of running stages, batch by batch, from what their queries report about themselves."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping

from pyspark.sql.streaming import StreamingQuery

from ..schema import PROGRESS_LOG
from ..sources import Layers


class StageStopped(RuntimeError):
    """A stage ended before it had taken in what was there when it began."""


def _entry(run: str, stage: str, report: Mapping) -> tuple:
    """A row of the log from one report."""
    operators = report["stateOperators"]
    mark = report.get("eventTime", {}).get("watermark")
    return (
        run,
        stage,
        report["batchId"],
        report["timestamp"],
        report["durationMs"].get("triggerExecution", 0),
        report["numInputRows"],
        sum(operator["numRowsTotal"] for operator in operators),
        sum(operator["numRowsDroppedByWatermark"] for operator in operators),
        # Before the first batch with rows, the mark is the beginning of time.
        mark if mark and not mark.startswith("1970-01-01") else None,
    )


def _reports(query: StreamingQuery) -> list[dict]:
    return [report if isinstance(report, dict) else json.loads(report.json) for report in query.recentProgress]


def _last(layers: Layers, stage: str, log: str) -> int:
    """The number of the last batch in a log of a checkpoint, or -1."""
    spark = layers.spark
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{layers.checkpoint(stage)}/{log}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [file.getPath().getName() for file in files.listStatus(path)] if files.exists(path) else []
    return max((int(name) for name in names if name.isdigit()), default=-1)


def stopped_early(layers: Layers, stage: str) -> bool:
    """The stage has begun a batch that it has not finished: its offsets are written and its commit is not."""
    return _last(layers, stage, "offsets") > _last(layers, stage, "commits")


def follow(layers: Layers, pause: float = 0.25, **stages: StreamingQuery) -> None:
    """Wait for running stages and log one row for each of their batches, and one at the end with how it went.

    If a stage fails, or is stopped by somebody in the middle of a batch, the others are stopped and that is raised.
    Queries keep only their latest reports, so these are taken while the stages run.
    """
    run, rows = uuid.uuid4().hex, {}

    def take() -> None:
        for stage, query in stages.items():
            for report in _reports(query):
                rows[stage, report["batchId"]] = (*_entry(run, stage, report), "BATCH", None)

    def ended(stage: str, query: StreamingQuery, ours: bool) -> tuple[str, str | None]:
        if error := query.exception():
            return "FAILED", str(error)
        if stopped_early(layers, stage):
            return "STOPPED", "stopped with another stage" if ours else f"{stage} was stopped in the middle of a batch"
        return "COMPLETED", None

    stopped: set[str] = set()
    try:
        while any(query.isActive for query in stages.values()):
            take()
            if any(not query.isActive and (query.exception() or stopped_early(layers, stage)) for stage, query in stages.items()):
                break
            time.sleep(pause)
    finally:
        for stage, query in stages.items():
            if query.isActive:
                stopped.add(stage)
                query.stop()
        take()
        ends = {stage: ended(stage, query, stage in stopped) for stage, query in stages.items()}
        for stage, (status, message) in ends.items():
            rows[stage, None] = (run, stage, *[None] * 7, status, message)
        layers.create("progress_log")
        log = layers.spark.createDataFrame(list(rows.values()), "run_id string, stage string, batch long, started string, millis long, "
            "input_rows long, state_rows long, late_groups long, watermark string, status string, message string")  # fmt: skip
        typed = [log[f.name].cast(f.dataType).alias(f.name) for f in PROGRESS_LOG]
        layers.append(log.select(*typed).coalesce(1), "progress_log")
    for stage, query in stages.items():
        if stage not in stopped:
            query.awaitTermination()
    for stage, (status, message) in ends.items():
        if status == "STOPPED":
            raise StageStopped(message)
