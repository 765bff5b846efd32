"""Run log and file audit as events.

A run writes STARTED before it works and SUCCESS or FAILED after it; a file is STARTED, then
SUCCESS or FAILED, and SKIPPED by every later load that finds it done. Nothing is updated: `run_log`
and `file_log` fold the events to the newest state, so a driver that dies leaves STARTED behind.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Iterator

from pyspark.sql import DataFrame, functions as F

from ..sources.lake import Lake

RUN_LOG = "audit/run_log"
FILE_AUDIT = "audit/file_audit"
RUN_STARTED = "audit/run_started"
FILE_EVENTS = "audit/file_events"
RUN_LOG_SCHEMA = (
    "run_id string, pipeline_name string, layer string, table_name string, status string, "
    "rows_loaded bigint, rows_rejected bigint, error_message string, "
    "started_at timestamp_ntz, completed_at timestamp_ntz"
)
FILE_AUDIT_SCHEMA = (
    "run_id string, entity_name string, stage_name string, target_table_name string, file_name string, "
    "file_timestamp timestamp_ntz, status string, rows_loaded bigint, error_message string, "
    "started_at timestamp_ntz, completed_at timestamp_ntz"
)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass
class Run:
    """What a job reports about itself."""

    run_id: str
    rows_loaded: int = 0
    rows_rejected: int = 0


@contextmanager
def logged_run(lake: Lake, pipeline: str, layer: str, table: str) -> Iterator[Run]:
    """A STARTED row, then one SUCCESS or FAILED row; a failure is raised again, never swallowed."""
    run = Run(uuid.uuid4().hex)
    started = utc_now()

    def log(name: str, status: str, error: str | None, completed: datetime | None) -> None:
        row = (run.run_id, pipeline, layer, table, status, run.rows_loaded, run.rows_rejected, error, started, completed)
        lake.append(name, run.run_id, lambda: lake.spark.createDataFrame([row], RUN_LOG_SCHEMA).coalesce(1))

    log(RUN_STARTED, "STARTED", None, None)
    try:
        yield run
    except Exception as exc:
        log(RUN_LOG, "FAILED", f"{type(exc).__name__}: {exc}", utc_now())
        raise
    log(RUN_LOG, "SUCCESS", None, utc_now())


def _newest(lake: Lake, tables: tuple[str, ...], schema: str, keys: list[str], order: list[str]) -> DataFrame:
    rows = lake.spark.createDataFrame([], schema)
    for name in tables:
        found = lake.read_or_none(name)
        rows = rows if found is None else rows.unionByName(found)
    columns = rows.columns
    place = F.struct(*[F.expr(c).alias(f"o{i}") for i, c in enumerate(order)])
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), place).alias("r")).select("r.*")


def run_log(lake: Lake) -> DataFrame:
    """One row per run in its newest state."""
    return _newest(lake, (RUN_STARTED, RUN_LOG), RUN_LOG_SCHEMA, ["run_id"], ["completed_at is not null", "completed_at"])


def file_log(lake: Lake) -> DataFrame:
    """One row per entity, folder, target and file in its newest state; a load that skipped a
    file says so, whatever became of it before."""
    return _newest(lake, (FILE_EVENTS, FILE_AUDIT), FILE_AUDIT_SCHEMA, ["entity_name", "stage_name", "target_table_name", "file_name"],
                   ["started_at", "completed_at is not null", "completed_at"])
