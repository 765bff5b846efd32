"""Filters shared by the plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.columns import contains_folded, date_in, day_in, equals_folded, lead_date


def at_most(df: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` rows; all of them without a limit."""
    return df if limit is None else df.limit(limit)


def is_suppression() -> Column:
    return F.upper("rejection_reason").isin(*fv.SUPPRESSION_REASONS)


def category_filter(log: DataFrame, category: str) -> DataFrame:
    """'intake' keeps refused leads, 'sfmc' keeps blocked sends, anything else keeps all."""
    if category == "intake":
        return log.filter(~is_suppression())
    if category == "sfmc":
        return log.filter(is_suppression())
    return log


def reason_filter(log: DataFrame, reason: str | None) -> DataFrame:
    return log if not reason else log.filter(equals_folded("rejection_reason", reason))


def lead_or_log_date(start: str, end: str) -> Column:
    """Lead date in range, or no lead date and the log date in range."""
    return date_in("lead_date", start, end) | (
        F.col("lead_date").isNull() & day_in("rejected_at", start, end)
    )


def either_date(start: str, end: str) -> Column:
    """Lead date or log date in range."""
    return F.coalesce(date_in("lead_date", start, end), F.lit(False)) | day_in("rejected_at", start, end)


def leads_in(leads: DataFrame, start: str, end: str) -> DataFrame:
    """Staged leads whose file date, text in any accepted form, is in range."""
    return leads.withColumn("lead_date", lead_date("file_date")).filter(date_in("lead_date", start, end))


def prospects_in(prospects: DataFrame, start: str, end: str) -> DataFrame:
    return prospects.filter(date_in("file_date", start, end))


def events_in(fact: DataFrame, start: str, end: str) -> DataFrame:
    return fact.filter(day_in("event_timestamp", start, end))


def channel_filter(df: DataFrame, channel: str | None) -> DataFrame:
    return df if not channel or channel == "All" else df.filter(equals_folded("channel", channel))


def state_filter(df: DataFrame, state: str | None) -> DataFrame:
    return df if not state else df.filter(equals_folded("state", state))


def journey_contains(df: DataFrame, journey: str | None) -> DataFrame:
    return df if not journey else df.filter(contains_folded("journey_type", journey))


def stacked(*one_row_frames: DataFrame) -> DataFrame:
    """One row holding the columns of several one-row aggregates.

    A union and a final max over as many rows as frames; no cross join.
    """
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row_frames)
    return together.agg(*[F.max(c).alias(c) for c in together.columns])


def unpivoted(df: DataFrame, name: str, value: str, columns: dict[str, str]) -> DataFrame:
    """A one-row (or few-row) frame turned into (label, value) rows."""
    pairs = F.array(*[
        F.struct(F.lit(label).alias("n"), F.col(c).alias("v")) for c, label in columns.items()
    ])
    return df.select(F.explode(pairs).alias("p")).select(
        F.col("p.n").alias(name), F.col("p.v").alias(value)
    )
