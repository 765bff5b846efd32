"""Batch loading of files not loaded before."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.audit import FILE_AUDIT, FILE_AUDIT_SCHEMA, FILE_EVENTS, logged_run, utc_now
from .files import file_timestamp
from .lake import Lake


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Files of a folder with name, modification time, the time in the name and the path as
    readers note it in ``_source_path``. Spark lists them; their content is not read."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        .select("path", "modificationTime", F.col("_metadata.file_path").alias("_source_path"))
        .withColumn("file_name", F.element_at(F.split("path", "/"), -1))
        .withColumn("file_timestamp", file_timestamp("file_name"))
    )


def loaded_files(audit: DataFrame, entity: str, stage: str, target: str) -> DataFrame:
    """Names of the files that an earlier load has finished."""
    return audit.filter(
        (F.col("entity_name") == entity) & (F.col("stage_name") == stage)
        & (F.col("target_table_name") == target) & (F.col("status") == "SUCCESS")
    ).select("file_name").distinct()


def new_files(
    files: DataFrame, audit: DataFrame | None, entity: str, stage: str, target: str
) -> DataFrame:
    """Files without a SUCCESS row, oldest first; files without a time in the name lead."""
    fresh = files if audit is None else files.join(loaded_files(audit, entity, stage, target), "file_name", "left_anti")
    return fresh.orderBy(F.col("file_timestamp").asc_nulls_first(), "modificationTime", "file_name")


def load_new_files(
    lake: Lake, folder: str, entity: str, target: str,
    read: Callable[[SparkSession, list[str]], DataFrame],
    pattern: str = "*.csv", batch_files: int = 10_000, log_skipped: bool = True,
) -> int:
    """Loads all new files of a folder and audits each of them; returns the rows loaded.

    Files are taken oldest first, ``batch_files`` at a time (only their paths come to the
    driver), until none is left. A batch is named after entity, folder and paths and published
    as a whole: a failed job leaves no rows, and where a driver dies between publishing and
    auditing, files whose rows are already in the target are audited but not loaded again. Rows
    are told by their full path, so files of one name in several folders are different files;
    rows that the audit gives to another entity don't count. ``read`` must keep ``_source_path``.
    """
    if log_skipped:
        _log_skipped(lake, folder, entity, target, pattern)
    loaded = 0
    while True:
        rows = _load_batch(lake, folder, entity, target, read, pattern, batch_files)
        if rows is None:
            return loaded
        loaded += rows


def _log_skipped(lake: Lake, folder: str, entity: str, target: str, pattern: str) -> None:
    """A SKIPPED event for every file that an earlier load has finished; no name comes to the driver."""
    audit = lake.read_or_none(FILE_AUDIT)
    if audit is None:
        return
    now = F.lit(utc_now()).cast("timestamp_ntz")
    done = list_files(lake.spark, folder, pattern).join(loaded_files(audit, entity, folder, target), "file_name", "left_semi")
    lake.append(FILE_EVENTS, f"skipped-{uuid.uuid4().hex}", lambda: done.select(
        F.expr("uuid()").alias("run_id"), F.lit(entity).alias("entity_name"), F.lit(folder).alias("stage_name"),
        F.lit(target).alias("target_table_name"), "file_name", "file_timestamp", F.lit("SKIPPED").alias("status"),
        F.lit(0).cast("long").alias("rows_loaded"), F.lit(None).cast("string").alias("error_message"),
        now.alias("started_at"), now.alias("completed_at")))


def _load_batch(
    lake: Lake, folder: str, entity: str, target: str,
    read: Callable[[SparkSession, list[str]], DataFrame], pattern: str, batch_files: int,
) -> int | None:
    """One batch; None where no file is new."""
    spark = lake.spark
    audit = lake.read_or_none(FILE_AUDIT)
    picked = new_files(list_files(spark, folder, pattern), audit, entity, folder, target).limit(batch_files).collect()
    started = utc_now()

    def audit_rows(status: str, counts: dict[str, int], error: str | None, batch: str) -> None:
        now = None if status == "STARTED" else utc_now()
        rows = [
            (uuid.uuid4().hex, entity, folder, target, f["file_name"], f["file_timestamp"], status,
             counts.get(f["_source_path"], 0), error, started, now)
            for f in picked
        ]
        name = f"{batch}-{status.lower()}" + ("" if status == "SUCCESS" else f"-{uuid.uuid4().hex}")
        table = FILE_EVENTS if status == "STARTED" else FILE_AUDIT
        lake.append(table, name, lambda: spark.createDataFrame(rows, FILE_AUDIT_SCHEMA))

    with logged_run(lake, f"LOAD_NEW_FILES_{entity}", "RAW", target) as run:
        if not picked:
            return None
        wanted = spark.createDataFrame([(f["_source_path"],) for f in picked], "_source_path string")
        key = [entity, folder, target, *sorted(f["_source_path"] for f in picked)]
        batch = "load-" + hashlib.md5("\n".join(key).encode()).hexdigest()
        audit_rows("STARTED", {}, None, batch)

        def per_file(rows: DataFrame) -> dict[str, int]:
            # At most as many paths as the batch has files.
            found = rows.join(wanted, "_source_path", "left_semi").groupBy("_source_path").count()
            return {r["_source_path"]: r["count"] for r in found.collect()}

        def rows_of(paths: list[str]) -> DataFrame:
            rows = read(spark, paths)
            if "_source_path" not in rows.columns:
                raise ValueError("read must keep _source_path")
            return rows

        try:
            there = lake.read_or_none(target)
            counts = {}
            if there is not None and "_source_path" in there.columns:
                counts = per_file(there)
                if counts and audit is not None:
                    others = audit.filter(
                        (F.col("entity_name") != entity) & (F.col("stage_name") == folder)
                        & (F.col("target_table_name") == target) & (F.col("status") == "SUCCESS")
                    ).select("file_name")
                    names = spark.createDataFrame([(f["file_name"],) for f in picked], "file_name string")
                    theirs = {r[0] for r in names.join(others, "file_name", "left_semi").collect()}
                    counts = {f["_source_path"]: counts[f["_source_path"]] for f in picked
                              if f["_source_path"] in counts and f["file_name"] not in theirs}
            paths = [f["path"] for f in picked if f["_source_path"] not in counts]
            if paths:
                run.rows_loaded = lake.append(target, batch, lambda: rows_of(paths))
                counts |= per_file(lake.read_batch(target, batch))
        except Exception as exc:
            audit_rows("FAILED", {}, f"{type(exc).__name__}: {exc}", batch)
            raise
        audit_rows("SUCCESS", counts, None, batch)
        return run.rows_loaded
