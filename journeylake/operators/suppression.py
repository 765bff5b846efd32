"""Suppression logging and fact flagging from the wide journey table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.columns import blank_to_null, truthy
from .quality import reject_rows
from .star import suppressed_prospects

FLAG_REASON = "Prospect unsubscribed — journey suppression flag active"


def suppression_rejects(journey_details: DataFrame, rejected_at: Column | None = None) -> DataFrame:
    """Reject rows for flagged prospects, one per (id, file, row)."""
    flagged = (
        journey_details.filter(truthy("suppression_flag") & blank_to_null("prospect_id").isNotNull())
        .groupBy("prospect_id", "_source_file_name", "_source_row_number")
        .agg(F.min("_loaded_at").alias("_loaded_at"))
        .withColumn("rejection_reason", F.lit("SUPPRESSED_PROSPECT"))
    )
    fields = {
        "PROSPECT_ID": "prospect_id",
        "SUPPRESSION_FLAG": F.lit("YES"),
        "_SOURCE_FILE_NAME": "_source_file_name",
        "_SOURCE_ROW_NUMBER": "_source_row_number",
    }
    return reject_rows(flagged, fv.ENGAGEMENT_TABLE, fields, "SFMC_SUPPRESSION_DETECTION", rejected_at)


def flag_suppressed(fact: DataFrame, journey_details: DataFrame) -> DataFrame:
    """The fact with every not yet suppressed row of a flagged prospect marked."""
    flagged = suppressed_prospects(journey_details).select(
        F.col("prospect_id").alias("subscriber_key"), F.lit(True).alias("_flagged")
    )
    hit = F.coalesce("_flagged", F.lit(False)) & ~F.coalesce("is_suppressed", F.lit(False))
    return (
        fact.join(flagged, "subscriber_key", "left")
        .withColumn("suppression_reason", F.when(hit, FLAG_REASON).otherwise(F.col("suppression_reason")))
        .withColumn("is_suppressed", hit | F.coalesce("is_suppressed", F.lit(False)))
        .drop("_flagged")
        .select(*fact.columns)
    )
