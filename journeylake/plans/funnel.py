"""Funnel volumes, funnel chart data, drop analysis and KPI list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.columns import count_when, date_in, day_in, event_counts, lead_date, pct, ratio
from .common import events_in, is_suppression, leads_in, prospects_in, stacked, unpivoted


def _row_count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def funnel_metrics(
    leads: DataFrame, prospects: DataFrame, intake: DataFrame, dates: DataFrame, fact: DataFrame,
    rejects: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
) -> DataFrame:
    """One row, sixteen measures; every table is read once."""
    unique = F.coalesce("is_unique", F.lit(False))
    is_open = F.col("event_type") == "OPEN"
    is_click = F.col("event_type") == "CLICK"
    events = events_in(fact, start, end).agg(
        *event_counts(sent_count="SENT", bounce_count="BOUNCE", open_count="OPEN", click_count="CLICK",
                      unsubscribe_count="UNSUBSCRIBE"),
        count_when(is_open & unique).alias("unique_open_count"),
        count_when(is_click & unique).alias("unique_click_count"),
    )
    days = dates.filter(date_in("full_date", start, end)).select("date_key")
    row = stacked(
        leads_in(leads, start, end).agg(_row_count("lead_count")),
        prospects_in(prospects, start, end).agg(_row_count("prospect_count")),
        intake.join(days, "date_key").agg(_row_count("prospect_intake_events")),
        events,
        rejects.filter(is_suppression() & day_in("rejected_at", start, end)).agg(_row_count("suppressed_count")),
    )
    delivered = F.col("sent_count") - F.col("bounce_count")
    return row.select(
        "lead_count",
        (F.col("lead_count") - F.col("prospect_count")).alias("invalid_lead_count"),
        "prospect_count",
        pct("prospect_count", "lead_count", 2).alias("lead_to_prospect_pct"),
        "prospect_intake_events",
        "sent_count",
        "suppressed_count",
        delivered.alias("estimated_delivered"),
        "bounce_count",
        "open_count",
        "unique_open_count",
        "click_count",
        "unique_click_count",
        "unsubscribe_count",
        pct("open_count", delivered, 2).alias("open_rate_pct"),
        pct("click_count", delivered, 2).alias("click_rate_pct"),
    )


def funnel_chart_data(
    leads: DataFrame, prospects: DataFrame, fact: DataFrame,
    start: str = fv.START_DATE, end: str = fv.END_DATE,
) -> DataFrame:
    """Five ordered stages with their share of the first."""
    row = stacked(
        leads_in(leads, start, end).agg(_row_count("lead")),
        prospects_in(prospects, start, end).agg(_row_count("prospect")),
        events_in(fact, start, end).agg(*event_counts(sent="SENT", opened="OPEN", clicked="CLICK")),
    )
    columns = ("lead", "prospect", "sent", "opened", "clicked")
    steps = F.array(*[
        F.struct(F.lit(i + 1).alias("stage_order"), F.lit(label).alias("stage"), F.col(c).alias("cnt"))
        for i, (c, label) in enumerate(zip(columns, fv.FUNNEL_CHART_STAGES))
    ])
    return row.select("lead", F.explode(steps).alias("s")).select(
        "s.*", pct("s.cnt", "lead", 2).alias("pct_of_initial")
    ).orderBy("stage_order")


def drop_analysis(
    leads: DataFrame, prospects: DataFrame, rejects: DataFrame, fact: DataFrame, day: str
) -> DataFrame:
    """All signals of one day as (signal, count, date) rows."""
    label = F.lit(day).alias("date")
    total = F.count(F.lit(1)).alias("count")

    def always(df: DataFrame, name: str) -> DataFrame:
        return df.agg(total).select(F.lit(name).alias("signal"), "count", label)

    def per(df: DataFrame, prefix: str, c: str) -> DataFrame:
        return df.groupBy(c).agg(total).select(F.concat(F.lit(prefix), F.col(c)).alias("signal"), "count", label)

    logged = rejects.filter(day_in("rejected_at", day, day))
    return (
        always(leads_in(leads, day, day), "Lead Intake")
        .unionByName(always(prospects_in(prospects, day, day), "Valid Prospects Mastered"))
        .unionByName(per(logged.filter(F.col("table_name") == fv.MASTER_TABLE), "Rejected Leads - ", "rejection_reason"))
        .unionByName(per(events_in(fact, day, day), "SFMC - ", "event_type"))
        .unionByName(per(logged.filter(is_suppression()), "SFMC Suppression - ", "rejection_reason"))
        .orderBy("signal")
    )


def kpis(
    leads: DataFrame, prospects: DataFrame, fact: DataFrame, rejects: DataFrame, paths: DataFrame
) -> DataFrame:
    """The seventeen canonical KPIs as (kpi, value) rows, from the specification.

    ``paths`` is `journeys.path_membership`; completion is taken over its first path.
    The trust score is the share of prospects' events not lost to suppression.
    """
    reason = F.upper("rejection_reason")
    row = stacked(
        leads.agg(_row_count("lead_count")),
        prospects.agg(_row_count("valid_prospect_count")),
        fact.agg(
            _row_count("event_rows"),
            *event_counts(sent="SENT", bounce="BOUNCE", opened="OPEN", clicked="CLICK", unsub="UNSUBSCRIBE"),
            count_when(F.coalesce("is_suppressed", F.lit(False))).alias("suppressed_rows"),
        ),
        rejects.agg(
            count_when(~is_suppression()).alias("invalid_lead_count"),
            count_when(reason.isin("SUPPRESSED", "SUPPRESSED_PROSPECT")).alias("suppressed_send_count"),
            count_when(reason == "FATAL_ERROR").alias("fatal_error_count"),
        ),
        paths.filter(F.col("path") == "HIGH").agg(
            F.max(F.when(F.col("stage_number") == 1, F.col("reached"))).alias("entered"),
            F.max("completed").alias("completed"),
        ),
    )
    delivered = F.col("sent") - F.col("bounce")
    expected = F.col("sent") + F.col("suppressed_send_count") + F.col("fatal_error_count")
    values = {
        "lead_count": F.col("lead_count").cast("double"),
        "invalid_lead_count": F.col("invalid_lead_count").cast("double"),
        "valid_prospect_count": F.col("valid_prospect_count").cast("double"),
        "lead_to_prospect_conversion_rate": ratio("valid_prospect_count", "lead_count", 1.0),
        "rejection_rate": ratio("invalid_lead_count", "lead_count", 1.0),
        "suppressed_send_count": F.col("suppressed_send_count").cast("double"),
        "fatal_error_count": F.col("fatal_error_count").cast("double"),
        "expected_send_count": expected.cast("double"),
        "actual_send_count": F.col("sent").cast("double"),
        "delivery_rate": ratio(delivered, "sent", 1.0),
        "open_rate": ratio("opened", delivered, 1.0),
        "click_rate": ratio("clicked", delivered, 1.0),
        "bounce_rate": ratio("bounce", "sent", 1.0),
        "unsubscribe_rate": ratio("unsub", delivered, 1.0),
        "journey_completion_rate": ratio("completed", "entered", 1.0),
        "data_quality_issue_rate": ratio("invalid_lead_count", "lead_count", 1.0),
        "signal_trust_score": F.lit(1.0) - ratio("suppressed_rows", "event_rows", 1.0),
    }
    return unpivoted(row.select(*[v.alias(k) for k, v in values.items()]), "kpi", "value", {k: k for k in values})


def leads_minus_prospects(leads: DataFrame, prospects: DataFrame) -> DataFrame:
    """Lead and prospect volume per day and the difference (drop), one shuffle of tagged days."""
    tagged = leads.select(lead_date("file_date").alias("day"), F.lit(1).alias("l"), F.lit(0).alias("p")).unionByName(
        prospects.select(F.col("file_date").alias("day"), F.lit(0).alias("l"), F.lit(1).alias("p"))
    )
    return tagged.filter("day is not null").groupBy("day").agg(
        F.sum("l").alias("leads"), F.sum("p").alias("prospects")
    ).withColumn("gap", F.col("leads") - F.col("prospects"))
