"""Run records and quality logs as append-only tables.

An id is taken by creating a file of its name, which a file system grants once, so two jobs never share one. Each
event and each batch of log rows is a folder of its own.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.schemas import DATA_QUALITY_LOGS
from tallyloom.sources.folders import claim, names

STARTED, COMPLETED, FAILED = "STARTED", "COMPLETED", "FAILED"

EVENTS = (
    "run_id bigint, pipeline_name string, status string, event_time timestamp, "
    "records_processed bigint, error_message string"
)
_BATCH = "batch"


def runs_sql(events: str) -> str:
    """SQL for one row per run: its start and its latest state. A closing event wins over a start."""
    latest = ", ".join(
        f"max_by({c}, place) AS {c}" for c in ("pipeline_name", "status", "records_processed", "error_message")
    )
    placed = f"SELECT *, struct(event_time, status <> '{STARTED}' AS closing) AS place FROM {events}"
    return (
        "SELECT run_id, pipeline_name, status, start_time, end_time, records_processed, error_message"
        f" FROM (SELECT run_id, {latest}, min(event_time) AS start_time,"
        f" max(CASE WHEN status <> '{STARTED}' THEN event_time END) AS end_time FROM ({placed}) GROUP BY run_id)"
    )


def current_runs(events: DataFrame) -> DataFrame:
    """One row per run: its start and its latest state. A closing event wins over a start."""
    return events.sparkSession.sql(runs_sql("{run_events}"), run_events=events)


class AuditLog:
    """The run events and quality logs under one folder, which any number of jobs may write."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = f"{root}/audit"

    def folders(self, table: str) -> dict[str, str]:
        """The folders of ``run_events`` or ``data_quality_logs`` by their names."""
        path = f"{self.root}/{table}"
        return {name: f"{path}/{name}" for name in names(self.spark, path)}

    def _read(self, table: str, schema: str | T.StructType) -> DataFrame:
        paths = self.folders(table).values()
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def events(self) -> DataFrame:
        return self._read("run_events", EVENTS)

    def runs(self) -> DataFrame:
        return current_runs(self.events())

    def logs(self) -> DataFrame:
        return self._read(DATA_QUALITY_LOGS.name, DATA_QUALITY_LOGS.schema)

    def _append(self, table: str, rows: list[tuple], schema: str | T.StructType) -> None:
        batch = self.spark.createDataFrame(rows, schema).coalesce(1)
        batch.write.parquet(f"{self.root}/{table}/{_BATCH}-{uuid.uuid4().hex}")

    def _ids(self, kind: str, count: int) -> list[int]:
        """The next free ids, rising; those of another job may lie between them."""
        folder, taken = f"{self.root}/ids/{kind}", []
        at = max(map(int, names(self.spark, folder)), default=0)
        while len(taken) < count:
            at += 1
            if claim(self.spark, f"{folder}/{at}"):
                taken.append(at)
        return taken

    def start(self, name: str, now: dt.datetime) -> int:
        """Open a run and return its id."""
        [run_id] = self._ids("run_id", 1)
        self._append("run_events", [(run_id, name, STARTED, now, None, None)], EVENTS)
        return run_id

    def end(
        self, run_id: int, name: str, status: str, records: int, now: dt.datetime,
        error: str | None = None,
    ) -> None:
        self._append("run_events", [(run_id, name, status, now, records, error)], EVENTS)

    def log_checks(self, run_id: int, rows: DataFrame, now: dt.datetime) -> None:
        """Append log rows. A batch has a few rows per table."""
        told = rows.collect()
        if told:
            numbered = [(i, run_id, *row, now) for i, row in zip(self._ids("log_id", len(told)), told)]
            self._append(DATA_QUALITY_LOGS.name, numbered, DATA_QUALITY_LOGS.schema)
