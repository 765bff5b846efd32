"""Identity resolution, the prospect master and the bronze copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.columns import lead_date, lead_timestamp, rounded_int
from .keyed import assign_dense_keys, first_per_key, next_key, unseen


def identity_key() -> Column:
    return F.concat_ws(
        "|", F.upper(F.trim("first_name")), F.upper(F.trim("last_name")), F.lower(F.trim("email"))
    )


def new_identities(valid: DataFrame, xref: DataFrame) -> DataFrame:
    """One row per identity key that the cross-reference lacks, with the smallest raw
    spelling of the names, so that case variants of one person give one identity."""
    people = valid.select(
        identity_key().alias("identity_key"),
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        F.lower(F.trim("email")).alias("email"),
    )
    single = people.groupBy("identity_key").agg(
        F.min("first_name").alias("first_name"),
        F.min("last_name").alias("last_name"),
        F.min("email").alias("email"),
    )
    return unseen(single, xref, ["identity_key"])


def resolve_identity(valid: DataFrame, xref: DataFrame, first: int | None = None) -> DataFrame:
    """New cross-reference rows. Numbers continue after the largest one in ``xref``."""
    if first is None:
        first = next_key(xref, "master_number", fv.FIRST_MASTER_NUMBER)
    keyed = assign_dense_keys(new_identities(valid, xref), ["identity_key"], first, "master_number")
    return keyed.select(
        F.format_string(fv.MASTER_ID_FORMAT, "master_number").alias("master_patient_id"),
        "master_number", "identity_key", "first_name", "last_name", "email",
    )


def typed_prospects(valid: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Normalised and typed columns of valid leads (no shuffle)."""
    return valid.select(
        *extra,
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        F.lower(F.trim("email")).alias("email"),
        F.trim("phone_number").alias("phone_number"),
        rounded_int("age").alias("age"),
        "address",
        "apartment_no",
        "city",
        F.upper("state").alias("state"),
        "zip_code",
        F.coalesce(F.upper(F.trim("patient_consent")) == "TRUE", F.lit(False)).alias("patient_consent"),
        "channel",
        lead_timestamp("submission_timestamp").alias("submission_timestamp"),
        lead_date("file_date").alias("file_date"),
    )


TIE_BREAK = (
    "submission_timestamp", "channel", "phone_number", "age", "address", "apartment_no",
    "city", "state", "zip_code", "patient_consent", "first_name", "last_name",
)

DAY = ["master_patient_id", "file_date"]


def master_prospects(
    valid: DataFrame, xref: DataFrame, master: DataFrame | None = None, one_per_day: bool = True,
    record_ids: bool = True,
) -> DataFrame:
    """New master rows: valid leads joined to their identity, once per (id, file date).

    The record id is a hash of the row's own values, so a rerun gives the same id.
    ``one_per_day=False`` keeps every same-day row of one batch; without ``record_ids`` the
    caller adds them, by `with_record_ids`.
    """
    typed = typed_prospects(valid.withColumn("identity_key", identity_key()), ("identity_key",))
    rows = typed.join(xref.select("identity_key", "master_patient_id"), "identity_key").drop("identity_key")
    if master is not None:
        rows = unseen(rows, master, DAY)
    if one_per_day:
        rows = first_per_key(rows, DAY, [F.col(c).asc_nulls_first() for c in TIE_BREAK])
    return with_record_ids(rows, one_per_day) if record_ids else rows


def with_record_ids(rows: DataFrame, one_per_day: bool = True) -> DataFrame:
    """The columns of master rows that follow from others."""
    if one_per_day:
        record = F.md5(F.concat_ws("|", "master_patient_id", F.col("file_date").cast("string")))
    else:
        record = F.md5(F.concat_ws("|", *[
            F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in (*DAY, *TIE_BREAK)
        ]))
    return rows.select(
        record.alias("record_id"),
        *[c for c in rows.columns],
        F.current_timestamp().cast("timestamp_ntz").alias("phi_loaded_at"),
        F.lit(True).alias("is_active"),
    )


def append_bronze(master: DataFrame, bronze: DataFrame | None = None, narrow: bool = False) -> DataFrame:
    """Master rows bronze has not seen, tagged with their source layer."""
    rows = master if bronze is None else unseen(master, bronze, ["record_id"], narrow)
    return rows.withColumn("source_layer", F.lit("PHI_HUB"))
