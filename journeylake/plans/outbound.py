"""Reconciliation of the prospect dimension against the target system's snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import count_when, event_counts, pct

MISSING = "In DIM_PROSPECT but NOT in SFMC (not yet exported or load failed)"


def outbound_reconciliation(dim_prospect: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Distinct ids on each side, on both and on one only.

    A tagged union is grouped by id once; each id then counts once in one global
    aggregate, so repeated ids cost nothing after the map side.
    """
    tagged = dim_prospect.select(F.col("master_patient_id").alias("id"), F.lit(1).alias("d"), F.lit(0).alias("s"))
    tagged = tagged.unionByName(
        snapshot.select(F.col("prospect_id").alias("id"), F.lit(0).alias("d"), F.lit(1).alias("s"))
    )
    ids = tagged.filter("id is not null").groupBy("id").agg(F.max("d").alias("d"), F.max("s").alias("s"))
    return ids.agg(
        count_when(F.col("d") == 1).alias("dim_prospect_total"),
        count_when(F.col("s") == 1).alias("sfmc_prospect_c_total"),
        count_when((F.col("d") == 1) & (F.col("s") == 1)).alias("matched_in_both"),
        count_when((F.col("d") == 1) & (F.col("s") == 0)).alias("in_dim_not_sfmc"),
        count_when((F.col("d") == 0) & (F.col("s") == 1)).alias("in_sfmc_not_dim"),
    )


def outbound_full_join(dim_prospect: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Row-level status of every id on either side (full outer join)."""
    dim = dim_prospect.select(F.col("master_patient_id").alias("d_id"))
    snap = snapshot.select(F.col("prospect_id").alias("s_id"))
    return dim.join(snap, F.col("d_id") == F.col("s_id"), "full_outer").select(
        F.coalesce("d_id", "s_id").alias("prospect_id"),
        F.when(F.col("s_id").isNull(), "dimension_only").when(F.col("d_id").isNull(), "target_only")
        .otherwise("both").alias("status"),
    )


def outbound_missing(dim_prospect: DataFrame, snapshot: DataFrame, limit: int | None = None) -> DataFrame:
    rows = dim_prospect.join(
        snapshot.select(F.col("prospect_id").alias("master_patient_id")), "master_patient_id", "left_anti"
    ).select(
        "master_patient_id", "first_name", "last_name", "email", "primary_channel", "first_intake_date",
        F.lit(MISSING).alias("status"),
    )
    if limit is None:
        return rows
    return rows.orderBy(F.col("first_intake_date").desc_nulls_last(), "master_patient_id").limit(limit)


def outbound_engagement(
    dim_prospect: DataFrame, snapshot: DataFrame, fact: DataFrame, limit: int | None = 100
) -> DataFrame:
    """Matched prospects with their engagement; events are counted before the joins."""
    counts = fact.groupBy(F.col("subscriber_key").alias("master_patient_id")).agg(
        *event_counts(total_sends="SENT", total_opens="OPEN", total_clicks="CLICK"),
        F.max("event_timestamp").alias("last_engagement"),
    )
    # Several snapshot rows of one id with equal flags are one group whose counts add up.
    snap = snapshot.groupBy(
        F.col("prospect_id").alias("master_patient_id"), "marketing_consent", "high_engagement"
    ).agg(F.count(F.lit(1)).alias("copies"))
    rows = (
        dim_prospect.select("master_patient_id", "first_name", "last_name")
        .join(snap, "master_patient_id")
        .join(counts, "master_patient_id", "left")
    )
    for c in ("total_sends", "total_opens", "total_clicks"):
        rows = rows.withColumn(c, F.coalesce(F.col(c), F.lit(0)) * F.col("copies"))
    rows = rows.select(
        "master_patient_id", "first_name", "last_name", "marketing_consent", "high_engagement",
        "total_sends", "total_opens", "total_clicks",
        pct("total_opens", "total_sends", 1).alias("open_rate_pct"), "last_engagement",
    )
    if limit is None:
        return rows
    return rows.orderBy(F.col("total_sends").desc(), "master_patient_id").limit(limit)
