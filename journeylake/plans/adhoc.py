"""Frequently asked ad-hoc questions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import count_when, equals_folded, pct, truthy
from .common import leads_in, prospects_in, stacked
from .funnel import leads_minus_prospects


def top_channels(leads: DataFrame, n: int = 5) -> DataFrame:
    return leads.groupBy("channel").agg(F.count(F.lit(1)).alias("leads")).orderBy(
        F.col("leads").desc(), "channel").limit(n)


def prospects_by_state(prospects: DataFrame) -> DataFrame:
    return prospects.groupBy("state").agg(F.count(F.lit(1)).alias("prospects"))


def distinct_emails(prospects: DataFrame) -> DataFrame:
    return prospects.agg(F.countDistinct("email").alias("distinct_emails"))


def consent_rate_by_channel(leads: DataFrame) -> DataFrame:
    return leads.groupBy("channel").agg(
        F.count(F.lit(1)).alias("leads"), count_when(truthy("patient_consent")).alias("consented")
    ).withColumn("consent_pct", pct("consented", "leads", 2))


def consented_via(prospects: DataFrame, channel: str) -> DataFrame:
    return prospects.filter(equals_folded("channel", channel) & F.col("patient_consent"))


def largest_drops(leads: DataFrame, prospects: DataFrame, n: int = 10) -> DataFrame:
    """Days with the most leads that did not become prospects."""
    days = leads_minus_prospects(leads, prospects)
    return days.withColumn("drop_pct", pct("gap", "leads", 2)).orderBy(F.col("gap").desc(), "day").limit(n)


def days_without_intake(prospects: DataFrame) -> DataFrame:
    """Calendar days between the first and last intake on which no prospect came in."""
    span = prospects.agg(F.min("file_date").alias("lo"), F.max("file_date").alias("hi")).filter("lo is not null")
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return days.join(prospects.select(F.col("file_date").alias("day")).distinct(), "day", "left_anti")


def compare_ranges(leads: DataFrame, prospects: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """Leads, prospects and conversion of two date ranges, one row each."""
    def one(label: str, start: str, end: str) -> DataFrame:
        row = stacked(
            leads_in(leads, start, end).agg(F.count(F.lit(1)).alias("leads")),
            prospects_in(prospects, start, end).agg(F.count(F.lit(1)).alias("prospects")),
        )
        return row.select(F.lit(label).alias("period"), "leads", "prospects", pct("prospects", "leads", 2).alias("conversion_pct"))

    return one(f"{first[0]}..{first[1]}", *first).unionByName(one(f"{second[0]}..{second[1]}", *second))
