"""Lead validation and the idempotent reject log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.columns import blank_to_null, lead_date, truthy
from .keyed import unseen

REJECT_COLUMNS = ("table_name", "rejection_reason", "rejected_record", "rejected_at", "lead_date", "rejected_hash")


def reject_reason(require_consent: bool = False) -> Column:
    """First failing rule of a staged lead, null for a valid one."""
    ladder = (
        F.when(blank_to_null("first_name").isNull(), "NULL_FIRST_NAME")
        .when(blank_to_null("last_name").isNull(), "NULL_LAST_NAME")
        .when(blank_to_null("email").isNull(), "NULL_EMAIL")
        .when(blank_to_null("phone_number").isNull(), "NULL_PHONE_NUMBER")
        .when(lead_date("file_date").isNull(), "INVALID_FILE_DATE")
    )
    if require_consent:
        ladder = ladder.when(~truthy("patient_consent"), fv.NO_CONSENT)
    return ladder


def validate_leads(leads: DataFrame, require_consent: bool = False) -> DataFrame:
    """Adds ``rejection_reason``; callers split on null. One pass, no shuffle."""
    return leads.withColumn("rejection_reason", reject_reason(require_consent))


def valid_leads(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("rejection_reason").isNull()).drop("rejection_reason")


def invalid_leads(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("rejection_reason").isNotNull())


def record_json(fields: Mapping[str, Column | str], stage: str) -> Column:
    """Reject record with a fixed key order; null fields are left out, so equal rows
    always give equal text."""
    parts = [
        (F.col(c) if isinstance(c, str) else c).cast("string").alias(name) for name, c in fields.items()
    ]
    return F.to_json(F.struct(*parts, F.lit(stage).alias("STAGE")))


LEAD_FIELDS = {
    "FIRST_NAME": "first_name",
    "LAST_NAME": "last_name",
    "EMAIL": "email",
    "PHONE_NUMBER": "phone_number",
    "CHANNEL": "channel",
    "FILE_DATE": "file_date",
}
SILVER_FIELDS = {
    "RECORD_ID": "record_id",
    "MASTER_PATIENT_ID": "master_patient_id",
    "FIRST_NAME": "first_name",
    "LAST_NAME": "last_name",
    "EMAIL": "email",
    "PHONE_NUMBER": "phone_number",
    "FILE_DATE": "file_date",
    "CHANNEL": "channel",
}


def reject_rows(
    rejected: DataFrame,
    table_name: str,
    fields: Mapping[str, Column | str],
    stage: str,
    rejected_at: Column | None = None,
    lead_day: Column | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Reject-log rows for frames that carry ``rejection_reason``.

    ``lead_date`` is a typed copy of the record's file date, so that date ranges filter a
    plain column of the stored log instead of parsing every record.
    """
    when = F.current_timestamp().cast("timestamp_ntz") if rejected_at is None else rejected_at
    return rejected.select(
        F.lit(table_name).alias("table_name"),
        "rejection_reason",
        record_json(fields, stage).alias("rejected_record"),
        when.alias("rejected_at"),
        (F.lit(None).cast("date") if lead_day is None else lead_day).alias("lead_date"),
        *carry,
    ).withColumn("rejected_hash", F.md5(F.col("rejected_record").cast("binary")))


def new_rejects(rows: DataFrame, log: DataFrame, narrow: bool = False) -> DataFrame:
    """Rows whose (table, reason, record) is not logged yet."""
    return unseen(rows, log, ["table_name", "rejection_reason", "rejected_hash"], narrow)


def reject_totals(rows: DataFrame) -> DataFrame:
    """Per-reason counts of one load."""
    return rows.groupBy("table_name", "rejection_reason").agg(F.count(F.lit(1)).alias("rejected_count"))


REJECT_JSON_SCHEMA = (
    "FILE_DATE string, FIRST_NAME string, LAST_NAME string, EMAIL string, PHONE_NUMBER string, "
    "CHANNEL string, PATIENT_CONSENT string, PROSPECT_ID string"
)


def parsed_rejects(log: DataFrame) -> DataFrame:
    """Reject log with the record parsed once (``rec``) and its lead date typed; text that
    is not a JSON object gives null fields. Logs written elsewhere may lack ``lead_date``;
    it is then read from the record."""
    parsed = log.withColumn("rec", F.from_json("rejected_record", REJECT_JSON_SCHEMA))
    if "lead_date" in log.columns:
        return parsed
    return parsed.withColumn("lead_date", lead_date("rec.FILE_DATE"))
