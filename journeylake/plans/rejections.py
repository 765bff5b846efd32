"""Reject-log analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .. import fixed_values as fv
from ..functions.columns import day_in, pct
from ..operators.quality import parsed_rejects
from .common import at_most, category_filter, either_date, is_suppression, lead_or_log_date, reason_filter


def _in_scope(rejects: DataFrame, start: str, end: str, reason: str | None, category: str) -> DataFrame:
    """Reason and category filter first (they reach the scan), then the parsed dates."""
    log = category_filter(reason_filter(rejects, reason), category)
    return parsed_rejects(log).filter(lead_or_log_date(start, end))


def _with_group_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn("lead_file_date", F.coalesce("lead_date", F.to_date("rejected_at")))


GROUP = ["lead_file_date", "table_name", "rejection_reason"]


def rejection_analysis(
    rejects: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    reason: str | None = None, category: str = "all", limit: int | None = 100,
) -> DataFrame:
    """Counts per (lead date, table, reason), top groups first: rejects and distinct e-mails.

    The log is read and parsed once. The e-mails themselves are rows of `rejection_emails`,
    so no cell grows with a group and none is cut.
    """
    rows = _with_group_date(_in_scope(rejects, start, end, reason, category))
    per_email = rows.groupBy(*GROUP, F.col("rec.EMAIL").alias("email")).agg(F.count(F.lit(1)).alias("n"))
    return at_most(
        per_email.groupBy(*GROUP)
        .agg(F.sum("n").alias("rejected_count"), F.count("email").alias("emails"))
        .orderBy(F.col("lead_file_date").desc_nulls_last(), F.col("rejected_count").desc(),
                 "rejection_reason", "table_name"), limit)


def rejection_emails(
    rejects: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    reason: str | None = None, category: str = "all",
) -> DataFrame:
    """Every distinct e-mail of every group, one per row."""
    rows = _with_group_date(_in_scope(rejects, start, end, reason, category))
    return rows.select(*GROUP, F.col("rec.EMAIL").alias("email")).filter("email is not null").distinct()


def rejected_details(
    rejects: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    reason: str | None = None, category: str = "intake", limit: int = 100,
) -> DataFrame:
    """Row-level rejects, newest lead date first (top-k)."""
    return (
        _in_scope(rejects, start, end, reason, category)
        .select(
            "rejection_id",
            F.to_date("rejected_at").alias("rejected_at_date"),
            "table_name", "rejection_reason",
            F.col("rec.FILE_DATE").alias("lead_file_date"),
            F.col("rec.FIRST_NAME").alias("first_name"),
            F.col("rec.LAST_NAME").alias("last_name"),
            F.col("rec.EMAIL").alias("email"),
            F.col("rec.PHONE_NUMBER").alias("phone_number"),
            F.col("rec.CHANNEL").alias("channel"),
            F.col("rec.PATIENT_CONSENT").alias("consent_flag"),
        )
        .orderBy(F.col("lead_file_date").desc_nulls_last(), F.col("rejected_at_date").desc(), "rejection_id")
        .limit(limit)
    )


def rejection_chart_data(
    rejects: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE, category: str = "all"
) -> DataFrame:
    """Reason, count and share. Counts are per reason (a handful of rows) before the
    window over all of them."""
    counts = _in_scope(rejects, start, end, None, category).groupBy("rejection_reason").agg(
        F.count(F.lit(1)).alias("cnt")
    )
    return counts.withColumn("share_pct", pct("cnt", F.sum("cnt").over(Window.partitionBy()), 2))


def suppression_counts(rejects: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE) -> DataFrame:
    """Blocked sends by reason with first and last day; either date may be in range."""
    rows = parsed_rejects(rejects.filter(is_suppression())).filter(either_date(start, end))
    return rows.groupBy(F.col("rejection_reason").alias("suppression_type")).agg(
        F.count(F.lit(1)).alias("count"),
        F.min(F.to_date("rejected_at")).alias("first_seen"),
        F.max(F.to_date("rejected_at")).alias("last_seen"),
    )


def suppression_share(
    rejects: DataFrame, prospects: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE
) -> DataFrame:
    """Blocked sends by reason as a share of mastered prospects (scalar subquery)."""
    from .common import prospects_in

    total = prospects_in(prospects, start, end).agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = suppression_counts(rejects, start, end)
    return counts.select(
        F.col("suppression_type").alias("rejection_reason"), "count",
        pct("count", total, 2).alias("pct_of_prospects"),
    )


def rejects_by_table(rejects: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE) -> DataFrame:
    return rejects.filter(day_in("rejected_at", start, end)).groupBy("table_name", "rejection_reason").agg(
        F.count(F.lit(1)).alias("rejection_count"),
        F.min(F.to_date("rejected_at")).cast("string").alias("first_seen"),
        F.max(F.to_date("rejected_at")).cast("string").alias("last_seen"),
    )


def daily_rejects(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy(F.to_date("rejected_at").alias("day")).agg(F.count(F.lit(1)).alias("rejected_count"))
