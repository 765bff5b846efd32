"""The dashboard's fetches as named frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.columns import count_when, event_counts
from ..operators.quality import parsed_rejects
from .common import channel_filter, either_date, events_in, is_suppression, leads_in, prospects_in, stacked, unpivoted
from .engagement import of_journey
from .trends import daily_trend


def filter_options(leads: DataFrame) -> DataFrame:
    return leads.select(
        F.coalesce(F.upper("channel"), F.lit("UNKNOWN")).alias("channel")
    ).distinct().orderBy("channel")


def funnel_kpis(
    leads: DataFrame, prospects: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    channel: str | None = None,
) -> DataFrame:
    row = stacked(
        channel_filter(leads_in(leads, start, end), channel).agg(F.count(F.lit(1)).alias("leads")),
        channel_filter(prospects_in(prospects, start, end), channel).agg(F.count(F.lit(1)).alias("prospects")),
    )
    return row.withColumn("invalid", F.greatest(F.col("leads") - F.col("prospects"), F.lit(0).cast("bigint")))


def email_kpis(
    fact: DataFrame, jobs: DataFrame, rejects: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    journey: str | None = None,
) -> DataFrame:
    """Expected, actual, suppressed, fatal and unsent sends; both spellings of a
    suppression count."""
    blocked = parsed_rejects(rejects.filter(is_suppression())).filter(either_date(start, end))
    reason = F.upper("rejection_reason")
    row = stacked(
        of_journey(events_in(fact, start, end), jobs, journey).agg(*event_counts(F.upper("event_type"), actual="SENT")),
        blocked.agg(
            count_when(reason.isin("SUPPRESSED", "SUPPRESSED_PROSPECT")).alias("suppressed"),
            count_when(reason == "FATAL_ERROR").alias("fatal"),
        ),
    )
    return row.select(
        (F.col("actual") + F.col("suppressed") + F.col("fatal")).alias("expected"),
        "actual", "suppressed", "fatal",
        (F.col("suppressed") + F.col("fatal")).alias("unsent"),
    )


def email_kpis_any(
    fact: DataFrame, raw_events: DataFrame, jobs: DataFrame, rejects: DataFrame, start: str = fv.START_DATE,
    end: str = fv.END_DATE, journey: str | None = None,
) -> DataFrame:
    """The figures from gold when it has a send in range, else from raw events, which know
    subscribers and days but no journey."""
    sends = of_journey(events_in(fact, start, end), jobs, journey).filter(F.upper("event_type") == "SENT")
    if sends.isEmpty():
        return email_kpis(raw_events, jobs, rejects, start, end)
    return email_kpis(fact, jobs, rejects, start, end, journey)


def conversion_raw(raw_events: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE) -> DataFrame:
    """From raw events: of the subscribers with a send, those who clicked, who opened without
    a click, and who did not open; a click without an open counts in the first and the last."""
    per = events_in(raw_events, start, end).groupBy("subscriber_key").agg(
        *event_counts(F.upper("event_type"), clicks="CLICK", opens="OPEN", sends="SENT")
    )
    return per.filter((F.col("sends") >= 1) & F.col("subscriber_key").isNotNull()).agg(
        count_when(F.col("clicks") >= 1).alias("high_count"),
        count_when((F.col("clicks") == 0) & (F.col("opens") >= 1)).alias("medium_count"),
        count_when(F.col("opens") == 0).alias("low_count"),
    )


def conversion_any(
    fact: DataFrame, raw_events: DataFrame, jobs: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    journey: str | None = None,
) -> DataFrame:
    """Gold when it has a click, open or send in range, else raw."""
    signals = of_journey(events_in(fact, start, end), jobs, journey).filter(F.upper("event_type").isin("CLICK", "OPEN", "SENT"))
    if signals.isEmpty():
        return conversion_raw(raw_events, start, end)
    return conversion(fact, jobs, start, end, journey)


def conversion(
    fact: DataFrame, jobs: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    journey: str | None = None,
) -> DataFrame:
    """Subscribers by their strongest signal: clicked, opened only, sent but unopened."""
    per = of_journey(events_in(fact, start, end), jobs, journey).groupBy("subscriber_key").agg(
        *event_counts(F.upper("event_type"), clicks="CLICK", opens="OPEN", sends="SENT")
    )
    return per.agg(
        count_when(F.col("clicks") >= 1).alias("high_count"),
        count_when((F.col("clicks") == 0) & (F.col("opens") >= 1)).alias("medium_count"),
        count_when((F.col("opens") == 0) & (F.col("sends") >= 1)).alias("low_count"),
    )


def prospect_segments(
    prospects: DataFrame, fact: DataFrame, jobs: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    journey: str | None = None, event_start: str | None = None, event_end: str | None = None,
) -> DataFrame:
    """Four overlapping segments over distinct jobs per prospect.

    The event range is part of the join condition in effect: prospects without events in
    range stay, with zero counts. It defaults to the intake range.
    """
    events = of_journey(events_in(fact, event_start or start, event_end or end), jobs, journey)
    kind = (
        F.when(F.upper("event_type").isin("BOUNCE", "UNSUBSCRIBE"), "NEG").otherwise(F.upper("event_type"))
    )
    # Distinct (subscriber, kind, job) first, so a hot subscriber shrinks before the shuffle.
    distinct = events.filter("job_id is not null").select("subscriber_key", kind.alias("kind"), "job_id").distinct()
    counts = distinct.groupBy("subscriber_key").agg(
        *event_counts("kind", clicks="CLICK", opens="OPEN", sends="SENT", neg="NEG")
    )
    ids = prospects_in(prospects, start, end).select("master_patient_id").distinct()
    c = F.col
    per = ids.join(counts, c("master_patient_id") == c("subscriber_key"), "left").na.fill(
        0, ["clicks", "opens", "sends", "neg"]
    )
    return per.agg(
        count_when(c("clicks") >= 1).alias("seg1"),
        count_when((c("clicks") == 0) & (c("opens") >= 2)).alias("seg2"),
        count_when((c("opens") <= 1) & (c("sends") >= 1) & (c("clicks") == 0) & (c("neg") == 0)).alias("seg3"),
        count_when((c("neg") >= 1) | ((c("sends") >= 1) & (c("opens") == 0) & (c("clicks") == 0))).alias("seg4"),
    )


def prospect_segments_any(
    prospects: DataFrame, fact: DataFrame, raw_events: DataFrame, jobs: DataFrame, start: str = fv.START_DATE,
    end: str = fv.END_DATE, journey: str | None = None, event_start: str | None = None, event_end: str | None = None,
) -> DataFrame:
    """Gold when it has an event in range, else the same counts from raw events, which know
    subscribers and jobs but no journey. Nothing is invented where neither has any."""
    span = dict(event_start=event_start or start, event_end=event_end or end)
    if of_journey(events_in(fact, *span.values()), jobs, journey).isEmpty():
        return prospect_segments(prospects, raw_events, jobs, start, end, **span)
    return prospect_segments(prospects, fact, jobs, start, end, journey, **span)


# Segment labels of the dashboard.
SEGMENT_LABELS = {
    "seg1": "1 - High Engagement",
    "seg2": "2 - Moderate Engagement",
    "seg3": "3 - Low Engagement",
    "seg4": "4 - At Risk",
}


def segment_rows(segments: DataFrame) -> DataFrame:
    return unpivoted(segments, "segment", "prospects", SEGMENT_LABELS)


def dashboard(
    leads: DataFrame, prospects: DataFrame, fact: DataFrame, jobs: DataFrame, rejects: DataFrame,
    start: str = fv.START_DATE, end: str = fv.END_DATE, channel: str | None = None, journey: str | None = None,
    raw_events: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All frames of one refresh; errors surface when a frame is used. With ``raw_events`` the
    frames on engagement fall back to them before gold holds events."""
    if raw_events is None:
        raw_events = fact.limit(0)
    return {
        "filter_options": filter_options(leads),
        "funnel_kpis": funnel_kpis(leads, prospects, start, end, channel),
        "email_kpis": email_kpis_any(fact, raw_events, jobs, rejects, start, end, journey),
        "conversion": conversion_any(fact, raw_events, jobs, start, end, journey),
        "segments": segment_rows(prospect_segments_any(prospects, fact, raw_events, jobs, start, end, journey)),
        "daily_trend": daily_trend(leads, prospects, start, end, channel),
    }
