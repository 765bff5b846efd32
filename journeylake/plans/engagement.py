"""Engagement counts by journey and event."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.columns import count_when, date_in, day_in
from ..functions.labels import journey_short_code
from .common import at_most, events_in, journey_contains


def with_job(fact: DataFrame, jobs: DataFrame, how: str = "left") -> DataFrame:
    """Fact rows with journey and stage; both sides are pre-selected."""
    return fact.join(jobs.select("job_key", "journey_type", "mapped_stage"), "job_key", how)


def engagement_stats(
    fact: DataFrame, jobs: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    journey: str | None = None, limit: int | None = None,
) -> DataFrame:
    """Journey × stage × event: count, unique count, first and last event.

    Events are aggregated per job first, so the look-up and the label grouping run on
    one row per (job, event type) however hot a job is.
    """
    per_job = events_in(fact, start, end).groupBy("job_key", "event_type").agg(
        F.count(F.lit(1)).alias("n"),
        count_when(F.coalesce("is_unique", F.lit(False))).alias("u"),
        F.min("event_timestamp").alias("lo"),
        F.max("event_timestamp").alias("hi"),
    )
    return at_most((
        journey_contains(with_job(per_job, jobs), journey)
        .groupBy(
            F.coalesce("journey_type", F.lit("Unknown Journey")).alias("journey_type"),
            F.coalesce("mapped_stage", F.lit("Unknown Stage")).alias("stage"),
            "event_type",
        )
        .agg(
            F.sum("n").alias("event_count"), F.sum("u").alias("unique_event_count"),
            F.min("lo").alias("first_event"), F.max("hi").alias("last_event"),
        )
        .orderBy("journey_type", "stage", "event_type")
    ), limit)


def engagement_stats_raw(
    raw_events: DataFrame, jobs: DataFrame, journey: str | None = None, limit: int | None = None
) -> DataFrame:
    """Fallback over the union of raw event tables: count and distinct subscribers."""
    joined = raw_events.join(jobs.select("job_id", "journey_type", "mapped_stage"), "job_id", "left")
    return at_most((
        journey_contains(joined, journey)
        .groupBy(
            F.coalesce("journey_type", F.lit("Unknown Journey")).alias("journey_type"),
            F.coalesce("mapped_stage", F.lit("Unknown Stage")).alias("stage"),
            "event_type",
        )
        .agg(F.count(F.lit(1)).alias("event_count"), F.countDistinct("subscriber_key").alias("unique_subscribers"))
        .orderBy("journey_type", "stage", "event_type")
    ), limit)


def engagement_stats_any(
    fact: DataFrame, raw_events: DataFrame, jobs: DataFrame,
    start: str = fv.START_DATE, end: str = fv.END_DATE, journey: str | None = None,
) -> DataFrame:
    """Gold when it has a row in range, else raw; decided by one row, not a count."""
    if events_in(fact, start, end).isEmpty():
        return engagement_stats_raw(raw_events, jobs, journey)
    return engagement_stats(fact, jobs, start, end, journey)


def engagement_pivot(
    fact: DataFrame, jobs: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    journey: str | None = None, journeys: tuple[str, ...] | None = None,
) -> DataFrame:
    """Event type × journey counts, 0-filled. Naming the journeys avoids a scan to find them."""
    per_job = events_in(fact, start, end).groupBy("job_key", "event_type").agg(F.count(F.lit(1)).alias("n"))
    rows = journey_contains(with_job(per_job, jobs, "inner"), journey)
    grouped = rows.groupBy("event_type")
    pivot = grouped.pivot("journey_type", list(journeys)) if journeys else grouped.pivot("journey_type")
    return pivot.agg(F.sum("n")).na.fill(0)


def engagement_pivot_any(
    fact: DataFrame, raw_events: DataFrame, jobs: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    journey: str | None = None, journeys: tuple[str, ...] | None = None,
) -> DataFrame:
    """The pivot when gold has an event of a known job in range, else the raw totals by event type."""
    if journey_contains(with_job(events_in(fact, start, end), jobs, "inner"), journey).isEmpty():
        return raw_event_totals(raw_events)
    return engagement_pivot(fact, jobs, start, end, journey, journeys)


def raw_event_totals(raw_events: DataFrame) -> DataFrame:
    return raw_events.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))


def journey_rates(fact: DataFrame, jobs: DataFrame) -> DataFrame:
    """Journeys ranked by open and bounce rate over sends."""
    from ..functions.columns import event_counts, pct

    per_job = fact.groupBy("job_key").agg(
        *event_counts(sends="SENT", opens="OPEN", clicks="CLICK", bounces="BOUNCE")
    )
    return (
        with_job(per_job, jobs, "inner").groupBy("journey_type")
        .agg(*[F.sum(c).alias(c) for c in ("sends", "opens", "clicks", "bounces")])
        .withColumn("open_rate_pct", pct("opens", "sends", 2))
        .withColumn("click_rate_pct", pct("clicks", "sends", 2))
        .withColumn("bounce_rate_pct", pct("bounces", "sends", 2))
        .orderBy(F.col("open_rate_pct").desc_nulls_last(), "journey_type")
    )


def of_journey(fact: DataFrame, jobs: DataFrame, journey: str | None) -> DataFrame:
    """Fact rows of a journey given as 'J01 - Welcome', 'J01' or None/'All'."""
    code = journey_short_code(journey)
    if code is None:
        return fact
    chosen = jobs.filter(F.upper("journey_type").startswith(code)).select("job_key")
    return fact.join(chosen, "job_key", "left_semi")


def daily_sketches(fact: DataFrame, precision: int = 14) -> DataFrame:
    """One mergeable sketch of subscribers per day and event type, to be stored: distinct counts
    over any span of days then read a few kilobytes a day instead of the events."""
    return fact.groupBy(F.to_date("event_timestamp").alias("event_day"), "event_type").agg(
        F.hll_sketch_agg("subscriber_key", F.lit(precision)).alias("subscribers"))


def distinct_from_sketches(sketches: DataFrame, start: str, end: str) -> DataFrame:
    """Approximate distinct subscribers per event type over a span of days."""
    return sketches.filter(date_in("event_day", start, end)).groupBy("event_type").agg(
        F.hll_sketch_estimate(F.hll_union_agg("subscribers")).alias("approx_subscribers"))


def sketch_accuracy(fact: DataFrame, sketches: DataFrame, start: str, end: str, tolerance: float = 0.02) -> DataFrame:
    """Exact distinct subscribers per event type, and whether the sketches come within ``tolerance``."""
    exact = fact.filter(day_in("event_timestamp", start, end)).groupBy("event_type").agg(
        F.countDistinct("subscriber_key").alias("unique_subscribers"))
    off = F.abs(F.coalesce("approx_subscribers", F.lit(0)) - F.col("unique_subscribers"))
    return exact.join(distinct_from_sketches(sketches, start, end), "event_type", "left").select(
        "event_type", "unique_subscribers", (off <= F.col("unique_subscribers") * tolerance).alias("within_tolerance"))
