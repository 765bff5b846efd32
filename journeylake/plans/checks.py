"""Integrity checks and balance formulas as (check, violations, passed) rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import blank_to_null, count_when, event_counts, truthy
from ..operators.star import map_email_to_stage
from .common import is_suppression, stacked
from .journeys import expected_next_stage


def _unresolved(rows: DataFrame, key: str, dimension: DataFrame, dim_key: str, name: str) -> DataFrame:
    """Rows whose key is not in the dimension; rows are counted per key before the join.
    A null key does not resolve."""
    per_key = rows.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    missing = per_key.join(dimension.select(F.col(dim_key).alias("_k")), "_k", "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


def _unlogged_suppressions(details: DataFrame, rejects: DataFrame) -> DataFrame:
    """Suppressed prospects of the journey table without a suppression in the log."""
    logged = rejects.filter(is_suppression() & (F.upper("rejection_reason") != "FATAL_ERROR")).select(
        F.get_json_object("rejected_record", "$.PROSPECT_ID").alias("prospect_id"))
    flagged = details.filter(truthy("suppression_flag")).join(logged, "prospect_id", "left_anti")
    return flagged.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("suppression_observability").alias("check_name"), "violations")


def integrity_checks(
    leads: DataFrame, prospects: DataFrame, rejects: DataFrame, fact: DataFrame, jobs: DataFrame,
    dates: DataFrame, types: DataFrame, dim_prospect: DataFrame, details: DataFrame,
) -> DataFrame:
    """Key coverage of the engagement fact, no mastered row that breaks a rule, refusals and
    suppressions that the log shows, and the five balances.

    Each side of a balance is counted by itself. Expected sends come from the journey table,
    actual ones are distinct (subscriber, stage) of later stages in the fact, and what is
    neither sent nor blocked is unsent, which may not be negative. Delivered are the sends
    whose (subscriber, job) has no bounce. `click_balance` is an assumption about data and may
    fail on real data; it is reported like the others. Synthetic suppressions carry no job.
    """
    with_job = fact.filter(F.col("event_type") != "SUPPRESSED")
    coverage = [
        _unresolved(fact, "subscriber_key", dim_prospect, "master_patient_id", "subscriber_identity_bridge_integrity"),
        _unresolved(with_job, "job_key", jobs, "job_key", "job_metadata_integrity"),
        _unresolved(fact, "date_key", dates, "date_key", "date_key_integrity"),
        _unresolved(fact, "event_type", types, "event_type", "engagement_type_integrity"),
        _unlogged_suppressions(details, rejects),
        _unresolved(prospects, "master_patient_id", dim_prospect, "master_patient_id", "valid_lead_promoted_to_prospect"),
    ]
    unique = F.coalesce("is_unique", F.lit(False))
    kind = F.col("event_type")
    blank = blank_to_null("email").isNull()
    per_job = fact.groupBy("subscriber_key", "job_id").agg(*event_counts(sends="SENT", bounces="BOUNCE"))
    stages = map_email_to_stage(jobs).filter("stage_number >= 2").select("job_id", "stage_number").distinct()
    later = per_job.filter("sends > 0").join(stages, "job_id").select("subscriber_key", "stage_number").distinct()
    row = stacked(
        expected_next_stage(details).agg(F.count(F.lit(1)).alias("expected")),
        later.agg(F.count(F.lit(1)).alias("answered")),
        per_job.agg(F.coalesce(F.sum(F.when(F.col("job_id").isNull() | (F.col("bounces") == 0), F.col("sends"))), F.lit(0)).alias("delivered")),
        leads.agg(F.count(F.lit(1)).alias("leads"), count_when(blank).alias("leads_blank")),
        prospects.agg(
            F.count(F.lit(1)).alias("valid"), count_when(blank).alias("mastered_blank"),
            count_when(~F.coalesce("patient_consent", F.lit(False))).alias("without_consent"),
        ),
        rejects.agg(
            count_when(~is_suppression()).alias("invalid"),
            count_when(is_suppression()).alias("blocked"),
            count_when(~is_suppression() & blank_to_null(F.get_json_object("rejected_record", "$.EMAIL")).isNull()).alias("refused_blank"),
        ),
        fact.agg(
            *event_counts(sent="SENT", bounced="BOUNCE", opened="OPEN", clicked="CLICK", suppressed="SUPPRESSED"),
            count_when((kind == "OPEN") & unique).alias("unique_opened"),
            count_when((kind == "CLICK") & unique).alias("unique_clicked"),
        ),
    )
    c = F.col
    # Leads that are neither mastered nor logged are the unresolved rest, which may not be negative.
    balances: dict[str, Column] = {
        "lead_to_prospect_balance": c("leads") >= c("valid") + c("invalid"),
        "send_balance": c("expected") >= c("answered") + c("blocked"),
        "delivery_balance": c("sent") >= c("delivered") + c("bounced"),
        "engagement_balance": (c("delivered") >= c("opened")) & (c("opened") >= c("unique_opened")),
        "click_balance": (c("opened") >= c("clicked")) & (c("clicked") >= c("unique_clicked")),
    }
    counted: dict[str, Column] = {
        # Mastered rows without an e-mail address, and leads without one that the log doesn't show.
        "intake_null_email_rejection": c("mastered_blank") + F.greatest(c("leads_blank") - c("refused_blank"), F.lit(0)),
        "no_consent_rejection": c("without_consent"),
        **{name: F.when(ok, 0).otherwise(1) for name, ok in balances.items()},
    }
    pairs = F.array(*[
        F.struct(F.lit(name).alias("check_name"), n.cast("bigint").alias("violations")) for name, n in counted.items()
    ])
    formulas = row.select(F.explode(pairs).alias("p")).select("p.*")
    return reduce(DataFrame.unionByName, [*coverage, formulas]).withColumn("passed", F.col("violations") == 0)
