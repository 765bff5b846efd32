"""First-match label ladders."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as fv
from .columns import col


def engagement_segment(
    clicks: Column | str = "clicks",
    opens: Column | str = "opens",
    bounces: Column | str = "bounces",
    unsubscribes: Column | str = "unsubscribes",
    sends: Column | str | None = "sends",
    short: bool = False,
) -> Column:
    """Five-way segment; with ``sends=None`` the last two rungs merge into Low."""
    def label(text: str) -> str:
        return text.split(" — ")[0] if short else text

    ladder = (
        F.when(col(clicks) > 0, label(fv.SEGMENT_HIGH))
        .when(col(opens) > 0, label(fv.SEGMENT_MID))
        .when((col(bounces) > 0) | (col(unsubscribes) > 0), label(fv.SEGMENT_RISK))
    )
    if sends is None:
        return ladder.otherwise(label(fv.SEGMENT_LOW))
    return ladder.when(col(sends) > 0, label(fv.SEGMENT_LOW)).otherwise(label(fv.SEGMENT_NONE))


def age_group(age: Column | str) -> Column:
    age = col(age)
    return (
        F.when(age < 18, "Under 18")
        .when(age <= 25, "18-25")
        .when(age <= 35, "26-35")
        .when(age <= 45, "36-45")
        .when(age <= 55, "46-55")
        .when(age <= 65, "56-65")
        .when(age > 65, "65+")
        .otherwise("Unknown")
    )


def census_region(state: Column | str) -> Column:
    ladder = None
    for region, states in fv.REGION_STATES.items():
        hit = col(state).isin(*states)
        ladder = F.when(hit, region) if ladder is None else ladder.when(hit, region)
    return ladder.otherwise("Other")


def channel_category(channel: Column | str) -> Column:
    return F.when(col(channel).isin(*fv.DIGITAL_CHANNELS), "Digital").otherwise("Other")


def journey_short_code(journey: str | None) -> str | None:
    """'J01' from 'J01 - Welcome'; None for no choice or 'All'."""
    if not journey or journey == "All":
        return None
    return journey.split(" - ")[0].strip().upper()
