"""One named query per operator, over the bound tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from journeylake.operators import star
from journeylake.plans import (
    adhoc, dashboard, engagement, funnel, health, journeys, outbound, prospects, rejections, scoring, trends,
)
from journeylake.sources import sql_access

from .bindings import JOURNEY_NAMES, TABLES, Bound

ALL = dict(start="1990-01-01", end="2099-12-31")
JAN = dict(start="2024-01-01", end="2024-01-30")


def _run_sql(b: Bound) -> DataFrame:
    sql_access.register({"bound_events": b.read("events")})
    return sql_access.run_sql(
        b.spark, "select event_type, count(*) n, sum(value) total from bound_events group by event_type")


def _no_events(b: Bound) -> DataFrame:
    """The engagement fact before its first load, which the raw events stand in for."""
    return b.fact().filter("false")


def _mapped_jobs(b: Bound) -> DataFrame:
    per_job = b.fact().groupBy("job_id").agg(F.count(F.lit(1)).alias("event_count"))
    jobs = per_job.join(b.jobs().select("job_id", "email_name"), "job_id")
    return star.map_email_to_stage(jobs).select(
        "job_id", "email_name", "journey_code", "stage_name", "stage_number", "is_resend", "event_count")


PLANS: dict[str, Callable[[Bound], DataFrame]] = {
    # funnel
    "funnel_metrics": lambda b: funnel.funnel_metrics(
        b.leads(), b.prospects(), b.intake(), b.calendar(), b.fact(), b.rejects(), **ALL),
    "funnel_chart_data": lambda b: funnel.funnel_chart_data(b.leads(), b.prospects(), b.fact(), **ALL),
    "drop_analysis": lambda b: funnel.drop_analysis(b.leads(), b.prospects(), b.rejects(), b.fact(), "2024-01-15"),
    "drop_analysis_intake": lambda b: funnel.drop_analysis(b.leads(), b.prospects(), b.rejects(), b.fact(), "1996-03-15"),
    "kpis": lambda b: funnel.kpis(
        b.leads(), b.prospects(), b.fact(), b.rejects(), journeys.path_membership(b.journey_details())),
    # rejections
    "rejection_analysis": lambda b: rejections.rejection_analysis(b.rejects(), **ALL),
    "rejection_analysis_intake": lambda b: rejections.rejection_analysis(
        b.rejects(), reason="null_phone_number", category="intake", **ALL),
    "rejection_emails": lambda b: rejections.rejection_emails(b.rejects(), **ALL),
    "rejected_details": lambda b: rejections.rejected_details(b.rejects(), **ALL),
    "rejected_details_sfmc": lambda b: rejections.rejected_details(b.rejects(), category="sfmc", **ALL),
    "rejection_chart_data": lambda b: rejections.rejection_chart_data(b.rejects(), **ALL),
    "suppression_counts": lambda b: rejections.suppression_counts(b.rejects(), **ALL),
    "suppression_share": lambda b: rejections.suppression_share(b.rejects(), b.prospects(), **ALL),
    "rejects_by_table": lambda b: rejections.rejects_by_table(b.rejects(), **ALL),
    "daily_rejects": lambda b: rejections.daily_rejects(b.rejects()),
    # engagement
    "engagement_stats": lambda b: engagement.engagement_stats(b.fact(), b.jobs(), **JAN),
    "engagement_stats_nurture": lambda b: engagement.engagement_stats(
        b.fact(), b.jobs(), "2024-01-05", "2024-01-12", "nurture"),
    "engagement_stats_raw": lambda b: engagement.engagement_stats_raw(b.raw_events(), b.jobs()),
    "engagement_stats_fallback": lambda b: engagement.engagement_stats_any(
        b.fact(), b.raw_events(), b.jobs(), "2030-01-01", "2030-12-31"),
    "engagement_pivot_fallback": lambda b: engagement.engagement_pivot_any(
        b.fact(), b.fact(), b.jobs(), "2030-01-01", "2030-12-31"),
    "engagement_pivot": lambda b: engagement.engagement_pivot(b.fact(), b.jobs(), journeys=JOURNEY_NAMES, **JAN),
    "distinct_from_sketches": lambda b: engagement.sketch_accuracy(
        b.fact(), engagement.daily_sketches(b.fact()), "2024-01-03", "2024-01-25"),
    "raw_event_totals": lambda b: engagement.raw_event_totals(b.raw_events()),
    "journey_rates": lambda b: engagement.journey_rates(b.fact(), b.jobs()),
    # scoring
    "conversion_scores": lambda b: scoring.conversion_scores(b.prospects(), b.fact(), **JAN),
    "segment_summary": lambda b: scoring.segment_summary(b.prospects(), b.fact(), "2024-01-10", "2024-01-10"),
    "segment_chart_data": lambda b: scoring.segment_chart_data(b.prospects(), b.fact(), **ALL),
    "raw_engagement_scores": lambda b: scoring.raw_engagement_scores(b.raw_events()),
    "conversion_scores_fallback": lambda b: scoring.conversion_scores_any(
        b.prospects(), _no_events(b), b.raw_events(), **JAN),
    "channel_consent_activity": lambda b: scoring.channel_consent_activity(b.prospects(), **ALL),
    "never_opened": lambda b: scoring.never_opened(b.fact()),
    # journeys
    "stage_send_summary": lambda b: journeys.stage_send_summary(b.journey_details()),
    "stage_send_summary_day": lambda b: journeys.stage_send_summary(b.journey_details(), day="2024-01-28"),
    "suppressed_last_stage": lambda b: journeys.suppressed_last_stage(b.journey_details(), b.unsubscribes()),
    "unsubscribe_reasons": lambda b: journeys.unsubscribe_reasons(b.unsubscribes()),
    "expected_next_stage": lambda b: journeys.expected_next_stage(b.journey_details()),
    "missed_sends": lambda b: journeys.missed_sends(b.journey_details(), b.fact(), b.rejects(), b.jobs()),
    "suppressed_between_stages": lambda b: journeys.suppressed_between_stages(b.journey_details(), b.unsubscribes()),
    "path_membership": lambda b: journeys.path_membership(b.journey_details()),
    "map_email_to_stage": _mapped_jobs,
    # prospects and outbound
    "trace_prospect": lambda b: prospects.trace_prospect(
        "Customer#000000007@example.com", b.leads(), b.rejects(), b.prospects(), b.xref()),
    "trace_prospect_id": lambda b: prospects.trace_prospect(
        "FIP0000000007", b.leads(), b.rejects(), b.prospects(), b.xref()),
    "trace_prospect_name": lambda b: prospects.trace_prospect(
        "nobody@example.com", b.leads(), b.rejects(), b.prospects(), b.xref(), name="Customer 000000007"),
    "trace_engagement": lambda b: prospects.trace_engagement(
        "FIP0000000007", b.prospects(), b.fact(), b.jobs()),
    "prospect_details": lambda b: prospects.prospect_details(b.prospects(), channel="2-high", state="ny", **ALL),
    "outbound_view": lambda b: prospects.outbound_view(b.dim_prospect()),
    "outbound_reconciliation": lambda b: outbound.outbound_reconciliation(b.dim_prospect(), b.snapshot()),
    "outbound_full_join": lambda b: outbound.outbound_full_join(b.dim_prospect(), b.snapshot()),
    "outbound_missing": lambda b: outbound.outbound_missing(b.dim_prospect(), b.snapshot()),
    "outbound_engagement": lambda b: outbound.outbound_engagement(b.dim_prospect(), b.snapshot(), b.fact()),
    # dashboard, trends, health
    "filter_options": lambda b: dashboard.filter_options(b.leads()),
    "dash_funnel_kpis": lambda b: dashboard.funnel_kpis(b.leads(), b.prospects(), channel="1-urgent", **ALL),
    "dash_email_kpis": lambda b: dashboard.email_kpis(
        b.fact(), b.jobs(), b.rejects(), "2024-01-03", "2024-01-20", "J02 - Nurture"),
    "dash_email_kpis_fallback": lambda b: dashboard.email_kpis_any(
        _no_events(b), b.fact(), b.jobs(), b.rejects(), "2024-01-03", "2024-01-20"),
    "dash_conversion_fallback": lambda b: dashboard.conversion_any(
        _no_events(b), b.fact(), b.jobs(), "2024-01-10", "2024-01-11"),
    "dash_conversion": lambda b: dashboard.conversion(b.fact(), b.jobs(), "2024-01-10", "2024-01-11"),
    "dash_segments": lambda b: dashboard.segment_rows(dashboard.prospect_segments(
        b.prospects(), b.fact(), b.jobs(), event_start="2024-01-10", event_end="2024-01-11", **ALL)),
    "dash_segments_fallback": lambda b: dashboard.segment_rows(dashboard.prospect_segments_any(
        b.prospects(), _no_events(b), b.fact(), b.jobs(), event_start="2024-01-10", event_end="2024-01-11", **ALL)),
    "daily_trend": lambda b: trends.daily_trend(b.leads(), b.prospects(), channel="5-Low", **ALL),
    "intake_trend_day": lambda b: trends.intake_trend(b.leads(), b.prospects(), group_by="day", **ALL),
    "intake_trend_week": lambda b: trends.intake_trend(b.leads(), b.prospects(), group_by="week", **ALL),
    "intake_trend_month": lambda b: trends.intake_trend(b.leads(), b.prospects(), group_by="quarterly?", **ALL),
    "run_summary": lambda b: health.run_summary(b.runs(), **ALL),
    "latest_runs": lambda b: health.latest_runs(b.runs()),
    "rejects_since_silver": lambda b: health.rejects_since_silver(b.runs(), b.rejects()),
    # ad hoc
    "adhoc_top_channels": lambda b: adhoc.top_channels(b.leads()),
    "adhoc_prospects_by_state": lambda b: adhoc.prospects_by_state(b.prospects()),
    "adhoc_distinct_emails": lambda b: adhoc.distinct_emails(b.prospects()),
    "adhoc_consent_by_channel": lambda b: adhoc.consent_rate_by_channel(b.leads()),
    "adhoc_consented_via": lambda b: adhoc.consented_via(b.prospects(), "3-medium").select(
        "record_id", "master_patient_id", "email", "file_date"),
    "adhoc_largest_drops": lambda b: adhoc.largest_drops(b.leads(), b.prospects()),
    "adhoc_days_without_intake": lambda b: adhoc.days_without_intake(b.prospects()),
    "adhoc_compare_ranges": lambda b: adhoc.compare_ranges(
        b.leads(), b.prospects(), ("1996-01-01", "1996-01-31"), ("1996-02-01", "1996-02-29")),
    "run_sql": _run_sql,
    "table_profile": lambda b: sql_access.table_profile({**{t: b.read(t) for t in TABLES}, "absent": None}).select(
        "table_name", "columns", "row_count", F.size("sample").alias("sample_rows"), "note"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from .jobs import JOBS

    def bind(plan: Callable[[Bound], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: plan(Bound(spark, folder))

    return {name: bind(plan) for name, plan in {**PLANS, **JOBS}.items()}
