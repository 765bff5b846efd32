"""Pipeline health from the run log and the reject log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from .common import at_most
from ..functions.columns import day_in
from ..session import fixed_table

# Jobs of the mid-run status, with their labels.
STATUS_JOBS = (
    ("PHI Load", "SP_LOAD_PHI_PROSPECT"),
    ("Bronze Load", "SP_LOAD_BRONZE_PROSPECT"),
    ("Silver Load", "SP_LOAD_SILVER_PROSPECT"),
)


def run_summary(runs: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE, limit: int | None = None) -> DataFrame:
    """Runs by table and status with first start and last completion."""
    return at_most((
        runs.filter(day_in("started_at", start, end)).groupBy("table_name", "status").agg(
            F.count(F.lit(1)).alias("run_count"),
            F.min("started_at").cast("string").alias("earliest_run"),
            F.max("completed_at").cast("string").alias("latest_run"),
        )
        .orderBy(F.col("run_count").desc(), "table_name", "status")
    ), limit)


def latest_runs(runs: DataFrame) -> DataFrame:
    """Latest run of each status job; a job without runs shows NOT FOUND."""
    names = fixed_table(runs.sparkSession, STATUS_JOBS, "step string, pipeline_name string")
    newest = runs.filter(F.col("pipeline_name").isin(*[p for _, p in STATUS_JOBS])).groupBy("pipeline_name").agg(
        F.max_by(F.struct("status", "rows_loaded", "error_message", "started_at", "completed_at"),
                 F.struct("started_at", "run_id")).alias("r")
    )
    return names.join(newest, "pipeline_name", "left").select(
        "step", "pipeline_name",
        F.coalesce("r.status", F.lit("NOT FOUND")).alias("status"),
        F.coalesce("r.rows_loaded", F.lit(0).cast("bigint")).alias("rows_loaded"),
        F.coalesce("r.error_message", F.lit("")).alias("error_message"),
        F.col("r.started_at").alias("started_at"),
        F.col("r.completed_at").alias("completed_at"),
    )


def rejects_since_silver(runs: DataFrame, rejects: DataFrame) -> DataFrame:
    """Reject count and 'reason = n | …' text since the latest silver start. The start is
    a scalar subquery; without any silver run the last two hours count. The text is built
    from one row per reason."""
    silver = F.col("pipeline_name") == STATUS_JOBS[2][1]
    start = runs.filter(silver).agg(F.max("started_at").alias("s")).scalar()
    since = F.coalesce(start, F.expr("cast(current_timestamp() - interval 2 hours as timestamp_ntz)"))
    per = rejects.filter(F.col("rejected_at") >= since).groupBy(
        F.coalesce("rejection_reason", F.lit("UNKNOWN")).alias("reason")
    ).agg(F.count(F.lit(1)).alias("n"))
    entry = F.struct((-F.col("n")).alias("o"), F.col("reason"), F.concat_ws(" = ", "reason", "n").alias("t"))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["t"]), " | ")
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("dq_count"),
        F.when(F.count(F.lit(1)) > 0, listed).otherwise("No DQ rejections.").alias("dq_summary"),
    )
