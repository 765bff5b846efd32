"""Single-prospect traces, prospect lists and outbound eligibility."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.columns import blank_to_null
from ..operators.quality import parsed_rejects
from .common import at_most, channel_filter, prospects_in, state_filter


def trace_prospect(
    identifier: str, leads: DataFrame, rejects: DataFrame, prospects: DataFrame, xref: DataFrame,
    name: str | None = None, limit: int | None = None,
) -> DataFrame:
    """Layered timeline of one e-mail address or master id.

    An id finds its leads through the identity key of its cross-reference row; ``name``
    adds leads whose 'first last' contains the text.
    """
    from ..operators.mastering import identity_key

    text = F.lit(None).cast("string")
    by_email = "@" in identifier

    def hit(c):
        return F.lower(c) == identifier.lower()

    full = F.concat_ws(" ", F.lower("first_name"), F.lower("last_name"))
    named = full.contains(name.lower()) if name else F.lit(False)
    if by_email:
        intake = leads.filter(hit("email") | named)
        mastered = prospects.filter(hit("email"))
        bridge = xref.filter(hit("email"))
    else:
        mastered = prospects.filter(F.col("master_patient_id") == identifier)
        bridge = xref.filter(F.col("master_patient_id") == identifier)
        keys = bridge.select(F.col("identity_key").alias("_key")).distinct()
        intake = leads.join(keys, identity_key() == F.col("_key"), "left").filter(F.col("_key").isNotNull() | named)
    logged = parsed_rejects(rejects)
    rejected = logged.filter(hit("rec.EMAIL")) if by_email else logged.filter(F.lit(False))

    def part(df: DataFrame, layer: str, channel, ts, label: str) -> DataFrame:
        return df.select(
            F.lit(layer).alias("layer"), "email", "first_name", "last_name",
            channel.alias("channel"), ts.cast("string").alias("ts"), F.lit(label).alias("lifecycle_label"),
        )

    timeline = (
        part(intake, "A_Intake", F.col("channel"), F.col("submission_timestamp"), "Lead")
        .unionByName(part(
            rejected.withColumns({
                "email": F.col("rec.EMAIL"), "first_name": F.col("rec.FIRST_NAME"), "last_name": F.col("rec.LAST_NAME"),
            }), "B_Rejected", F.col("rejection_reason"), F.col("rejected_at"), "Invalid Lead"))
        .unionByName(part(mastered, "C_Prospect", F.col("channel"), F.col("submission_timestamp"), "Prospect"))
        .unionByName(part(bridge, "D_Identity_Xref", F.col("identity_key"), text, "Identity Bridge"))
    )
    return at_most(timeline.orderBy("layer", "ts", "channel", "email", "first_name", "last_name"), limit)


def trace_engagement(
    identifier: str, prospects: DataFrame, fact: DataFrame, jobs: DataFrame, limit: int | None = None
) -> DataFrame:
    """Engagement of one prospect in time order; the id is a filter on both sides. Each
    event shows once however often the prospect came in."""
    chosen = F.lower("email") == identifier.lower() if "@" in identifier else F.col("master_patient_id") == identifier
    people = prospects.filter(chosen).select("master_patient_id").distinct()
    events = fact if "@" in identifier else fact.filter(F.col("subscriber_key") == identifier)
    return at_most((
        people.join(events, F.col("master_patient_id") == F.col("subscriber_key"))
        .join(jobs.select("job_key", "journey_type", "mapped_stage"), "job_key", "left")
        .select("event_type", "event_timestamp", "journey_type", "mapped_stage", "subscriber_key",
                "is_suppressed", "suppression_reason")
        .orderBy("event_timestamp", "event_type", "journey_type", "mapped_stage")
    ), limit)


def prospect_details(
    prospects: DataFrame, start: str = fv.START_DATE, end: str = fv.END_DATE,
    channel: str | None = None, state: str | None = None, limit: int = 100,
) -> DataFrame:
    """Row-level prospects, newest first (top-k)."""
    rows = state_filter(channel_filter(prospects_in(prospects, start, end), channel), state)
    return (
        rows.orderBy(F.col("file_date").desc(), F.col("submission_timestamp").desc(), "record_id").limit(limit)
        .select(
            F.col("master_patient_id").alias("master_prospect_id"), "record_id", "first_name", "last_name",
            "email", "phone_number", F.col("patient_consent").alias("consent_flag"), "channel", "file_date",
            F.col("submission_timestamp").cast("string").alias("submitted_at"), "is_active",
        )
    )


OUTBOUND_COLUMNS = (
    "master_patient_id", "first_name", "last_name", "email", "phone_number", "age", "age_group", "city",
    "state", "zip_code", "primary_channel", "patient_consent", "first_intake_date", "last_intake_date",
)


def outbound_view(dim_prospect: DataFrame) -> DataFrame:
    """Active, consenting prospects with a usable e-mail."""
    return dim_prospect.filter(
        F.col("is_active") & F.col("patient_consent") & blank_to_null("email").isNotNull()
        & (F.upper(F.trim("email")) != "N/A")
    ).select(*OUTBOUND_COLUMNS)
