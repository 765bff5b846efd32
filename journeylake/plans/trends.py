"""Intake over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from .common import channel_filter, leads_in, prospects_in


def _two_series(leads: DataFrame, prospects: DataFrame, period: str, lead_key: Column, prospect_key: Column) -> DataFrame:
    """Both series summed in one shuffle of tagged keys; a period missing on one side is 0."""
    both = leads.select(lead_key.alias(period), F.lit(1).alias("l"), F.lit(0).alias("p")).unionByName(
        prospects.select(prospect_key.alias(period), F.lit(0).alias("l"), F.lit(1).alias("p"))
    )
    return both.groupBy(period).agg(F.sum("l").alias("leads"), F.sum("p").alias("prospects"))


def intake_trend(
    leads: DataFrame, prospects: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    group_by: str = "month",
) -> DataFrame:
    """Leads, prospects and gap per day, week (from Monday) or month; anything else is month."""
    grain = group_by.lower() if group_by.lower() in ("day", "week", "month") else "month"

    def key(c: str) -> Column:
        return F.date_trunc(grain, F.col(c)).cast("date")

    series = _two_series(
        leads_in(leads, start, end), prospects_in(prospects, start, end), "period", key("lead_date"), key("file_date")
    )
    return series.withColumn("gap", F.col("leads") - F.col("prospects")).orderBy("period")


def daily_trend(
    leads: DataFrame, prospects: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    channel: str | None = None,
) -> DataFrame:
    return _two_series(
        channel_filter(leads_in(leads, start, end), channel),
        channel_filter(prospects_in(prospects, start, end), channel),
        "dt", F.col("lead_date"), F.col("file_date"),
    ).orderBy("dt")
