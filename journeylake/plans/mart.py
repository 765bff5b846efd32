"""The journey mart: one row per lead or engagement event, with dimensions and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, GroupedData, functions as F


FLAGS = ("is_expected_send", "is_actual_send", "is_delivered", "is_unique_event", "is_suppressed_event")


def _signals(intake: DataFrame, fact: DataFrame, jobs: DataFrame) -> DataFrame:
    """Leads and engagement events in one form, before they meet the prospect dimension."""
    flag = lambda c: F.when(c, 1).otherwise(0)
    kind = F.col("event_type")
    bounced = fact.filter(kind == "BOUNCE").select(
        F.col("subscriber_key").alias("b_key"), F.col("job_id").alias("b_job"), F.lit(True).alias("bounced")
    ).distinct()
    sends = fact.join(
        bounced, (kind == "SENT") & (F.col("subscriber_key") == F.col("b_key")) & (F.col("job_id") == F.col("b_job")),
        "left",
    )
    events = sends.join(jobs.select("job_key", "journey_type", "mapped_stage"), "job_key", "left").select(
        F.col("subscriber_key").alias("prospect_id"),
        kind.alias("event_type"),
        "event_timestamp",
        "date_key",
        "journey_type",
        "mapped_stage",
        flag(kind.isin("SENT", "SUPPRESSED")).alias("is_expected_send"),
        flag(kind == "SENT").alias("is_actual_send"),
        flag((kind == "SENT") & F.col("bounced").isNull()).alias("is_delivered"),
        flag(F.coalesce("is_unique", F.lit(False))).alias("is_unique_event"),
        flag(F.coalesce("is_suppressed", F.lit(False))).alias("is_suppressed_event"),
        "reason",
    )
    text = F.lit(None).cast("string")
    leads = intake.select(
        F.col("master_patient_id").alias("prospect_id"),
        F.lit("LEAD").alias("event_type"),
        F.col("submission_timestamp").alias("event_timestamp"),
        "date_key",
        text.alias("journey_type"),
        text.alias("mapped_stage"),
        *[F.lit(0).alias(c) for c in FLAGS],
        text.alias("reason"),
    )
    return leads.unionByName(events)


def _people(dim_prospect: DataFrame, geography: DataFrame) -> DataFrame:
    geo = geography.select(
        F.col("city").alias("g_city"), F.col("state").alias("g_state"), F.col("zip_code").alias("g_zip"), "region"
    )
    return dim_prospect.join(
        geo, (F.col("city") == F.col("g_city")) & (F.col("state") == F.col("g_state"))
        & (F.col("zip_code") == F.col("g_zip")), "left",
    ).select(F.col("master_patient_id").alias("prospect_id"), "primary_channel", "age_group", "state", "region",
             "patient_consent")


def journey_mart(
    intake: DataFrame, fact: DataFrame, jobs: DataFrame, dim_prospect: DataFrame, geography: DataFrame
) -> DataFrame:
    """Built from the specification: lead rows come from the intake fact, event rows from
    the engagement fact.

    Expected sends are SENT and SUPPRESSED rows, actual ones SENT rows. A SENT row counts
    as delivered when its (subscriber, job) has no BOUNCE. The rows are joined to the
    prospect dimension once, as one union.
    """
    return _signals(intake, fact, jobs).join(_people(dim_prospect, geography), "prospect_id", "left")


def _by_stage(rows: DataFrame, *more: str) -> GroupedData:
    return rows.groupBy(
        *more,
        F.coalesce("journey_type", F.lit("Unknown Journey")).alias("journey_type"),
        F.coalesce("mapped_stage", F.lit("Unknown Stage")).alias("stage"),
        "event_type",
    )


def mart_counts(
    intake: DataFrame, fact: DataFrame, jobs: DataFrame, dim_prospect: DataFrame, geography: DataFrame
) -> DataFrame:
    """`mart_summary` without building the mart: signals are counted per prospect first, so only
    one row per prospect, stage and event type meets the dimension."""
    per = _by_stage(_signals(intake, fact, jobs), "prospect_id").agg(
        F.count(F.lit(1)).alias("observations"), *[F.sum(c).alias(c) for c in FLAGS])
    regions = _people(dim_prospect, geography).select("prospect_id", "region")
    return per.join(regions, "prospect_id", "left").groupBy(
        "journey_type", "stage", "event_type", F.coalesce("region", F.lit("Unknown")).alias("region")
    ).agg(F.sum("observations").alias("observations"), *[F.sum(c).alias(c) for c in FLAGS])


def mart_summary(mart: DataFrame) -> DataFrame:
    """Counts of the mart's flags by journey, stage and event type."""
    return _by_stage(mart.withColumn("region", F.coalesce("region", F.lit("Unknown"))), "region").agg(
        F.count(F.lit(1)).alias("observations"), *[F.sum(c).alias(c) for c in FLAGS])
