"""Engagement scores and segments per prospect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed_values as fv
from ..functions.columns import col, count_when, event_counts, pct, ratio
from ..functions.labels import engagement_segment
from .common import at_most, events_in, prospects_in


def prospect_versions(prospects: DataFrame, active_only: bool) -> DataFrame:
    return prospects.filter("is_active") if active_only else prospects


COUNTS = dict(sends="SENT", opens="OPEN", clicks="CLICK", bounces="BOUNCE",
              unsubscribes="UNSUBSCRIBE", spam_complaints="SPAM")


def subscriber_counts(fact: DataFrame, start: str, end: str) -> DataFrame:
    """Event counts per subscriber: one partial and one final aggregation."""
    return events_in(fact, start, end).groupBy("subscriber_key").agg(
        *event_counts(**COUNTS), F.max("event_timestamp").alias("last_event_ts")
    )


def _capped(weighted: Column, sends: Column | str) -> Column:
    """least(100, weighted / sends × 50) rounded; null without sends, because least()
    would skip the null and answer 100."""
    return F.when(
        col(sends) > 0, F.round(F.least(F.lit(100.0), ratio(weighted, sends, 1.0) * 50), 1)
    )


def conversion_scores(
    prospects: DataFrame, fact: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    active_only: bool = True, limit: int | None = 100,
) -> DataFrame:
    """Scores per mastered prospect row, best conversion signal first.

    Events are counted per subscriber before the join, so the join never multiplies
    raw events. A prospect mastered with several identical (name, channel, date) rows is
    one group, and its counts are those of the joined rows.
    """
    group = ["master_patient_id", "first_name", "last_name", "email", "channel", "file_date"]
    people = prospect_versions(prospects, active_only).groupBy(*group).agg(F.count(F.lit(1)).alias("copies"))
    counts = subscriber_counts(fact, start, end).withColumnRenamed("subscriber_key", "master_patient_id")
    joined = people.join(counts, "master_patient_id")
    for name in COUNTS:
        joined = joined.withColumn(name, F.col(name) * F.col("copies"))
    scored = joined.select(
        F.col("master_patient_id").alias("master_prospect_id"),
        "first_name", "last_name", "email", "channel", F.col("file_date").alias("intake_date"),
        "sends", "opens", "clicks", "bounces", "unsubscribes",
        pct(F.col("opens") + F.col("clicks"), "sends", 1).alias("engagement_rate_pct"),
        _capped(F.col("clicks") * 2.0 + F.col("opens"), "sends").alias("conversion_signal_score"),
        _capped(
            F.col("bounces") * 1.5 + F.col("unsubscribes") * 2.0 + F.col("spam_complaints") * 3.0, "sends"
        ).alias("dropoff_risk_score"),
        engagement_segment().alias("engagement_segment"),
    )
    if limit is None:
        return scored
    return scored.orderBy(
        F.col("conversion_signal_score").desc_nulls_last(), F.col("dropoff_risk_score").asc_nulls_last(),
        "master_prospect_id", "intake_date", "channel",
    ).limit(limit)


def _per_prospect(prospects: DataFrame, fact: DataFrame, start: str, end: str, active_only: bool) -> DataFrame:
    people = prospect_versions(prospects, active_only).groupBy("master_patient_id").agg(
        F.count(F.lit(1)).alias("copies")
    )
    counts = subscriber_counts(fact, start, end).withColumnRenamed("subscriber_key", "master_patient_id")
    return people.join(counts, "master_patient_id")


def segment_summary(
    prospects: DataFrame, fact: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    active_only: bool = True,
) -> DataFrame:
    """Prospects, average engagement and share per segment. The share window covers at
    most five aggregated rows."""
    rows = _per_prospect(prospects, fact, start, end, active_only).select(
        engagement_segment().alias("segment"),
        ratio(F.col("opens") + F.col("clicks"), "sends").alias("rate"),
    )
    return (
        rows.groupBy("segment")
        .agg(F.count(F.lit(1)).alias("prospect_count"), F.round(F.avg("rate"), 1).alias("avg_engagement_rate_pct"))
        .withColumn("pct_of_total", pct("prospect_count", F.sum("prospect_count").over(Window.partitionBy()), 1))
    )


def segment_chart_data(
    prospects: DataFrame, fact: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE
) -> DataFrame:
    """Segment counts of active prospects and active/inactive prospect rows, as one frame."""
    segments = (
        _per_prospect(prospects, fact, start, end, True)
        .groupBy(engagement_segment(short=True).alias("label")).agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.lit("segment").alias("chart"), "label", "cnt")
    )
    status = F.when(F.col("is_active"), "Active").otherwise("Inactive / Dropped")
    activity = (
        prospects_in(prospects, start, end).groupBy(status.alias("label")).agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.lit("status").alias("chart"), "label", "cnt")
    )
    return segments.unionByName(activity)


def conversion_scores_any(
    prospects: DataFrame, fact: DataFrame, raw_events: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    active_only: bool = True, limit: int | None = 100,
) -> DataFrame:
    """Scores from gold once it holds an event, before that the raw scores per subscriber."""
    if fact.isEmpty():
        return raw_engagement_scores(raw_events, limit)
    return conversion_scores(prospects, fact, start, end, active_only, limit)


def raw_engagement_scores(raw_events: DataFrame, limit: int | None = 100) -> DataFrame:
    """Distinct jobs per subscriber and event type with rates and a four-way segment.

    Only subscribers with a send count. (subscriber, type, job) is made distinct first,
    so the fan-out of joining five event tables never arises.
    """
    kinds = dict(total_sends="SENT", total_opens="OPEN", total_clicks="CLICK",
                 total_bounces="BOUNCE", total_unsubscribes="UNSUBSCRIBE")
    jobs = raw_events.filter(F.col("event_type").isin(*kinds.values()) & F.col("job_id").isNotNull()).select(
        "subscriber_key", "event_type", "job_id").distinct()
    sent = raw_events.filter(F.col("event_type") == "SENT").select("subscriber_key").distinct()
    counts = jobs.groupBy("subscriber_key").agg(*event_counts(**kinds))
    rows = sent.join(counts, "subscriber_key", "left").na.fill(0, list(kinds)).select(
        "subscriber_key", *kinds,
        pct("total_opens", "total_sends", 1).alias("open_rate_pct"),
        pct("total_clicks", "total_sends", 1).alias("click_rate_pct"),
        engagement_segment("total_clicks", "total_opens", "total_bounces", "total_unsubscribes", None)
        .alias("engagement_segment"),
    )
    if limit is None:
        return rows
    return rows.orderBy(
        F.col("click_rate_pct").desc_nulls_last(), F.col("open_rate_pct").desc_nulls_last(), "subscriber_key"
    ).limit(limit)


def channel_consent_activity(
    prospects: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE, limit: int | None = None
) -> DataFrame:
    return at_most((
        prospects_in(prospects, start, end)
        .groupBy("channel", F.col("patient_consent").alias("consent_status"))
        .agg(
            F.count(F.lit(1)).alias("total_prospects"),
            count_when(F.col("is_active")).alias("active_prospects"),
            count_when(~F.col("is_active")).alias("inactive_prospects"),
        )
        .withColumn("active_rate_pct", pct("active_prospects", "total_prospects", 1))
        .withColumn("dropoff_rate_pct", pct("inactive_prospects", "total_prospects", 1))
        .orderBy(F.col("total_prospects").desc(), "channel", "consent_status")
    ), limit)


def never_opened(fact: DataFrame) -> DataFrame:
    """Subscribers with sends and no open (anti join on two distinct key sets)."""
    sent = fact.filter(F.col("event_type") == "SENT").groupBy("subscriber_key").agg(
        F.count(F.lit(1)).alias("sends"))
    opened = fact.filter(F.col("event_type") == "OPEN").select("subscriber_key")
    return sent.join(opened, "subscriber_key", "left_anti")
