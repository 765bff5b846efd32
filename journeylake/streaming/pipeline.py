"""The layer chain for one batch of leads or events.

Every step writes its batch to the lake and the next step reads that, so a lost executor
or a retried batch never repeats finished work, and a failure is raised to the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as fv
from ..functions.columns import lead_date
from ..operators import history, mastering, quality, star, suppression
from ..operators.audit import logged_run, utc_now
from ..operators.keyed import next_key
from ..plans import prospects
from ..sources.files import empty_events, export_csv
from ..sources.lake import Lake, values_of

# Raw entity behind each event type.
EVENT_ENTITIES = {
    "SENT": "sent", "OPEN": "opens", "CLICK": "clicks", "BOUNCE": "bounces",
    "UNSUBSCRIBE": "unsubscribes", "SPAM": "spam",
}
LOG = "audit/reject_log"


def _month(day: str) -> Column:
    return F.trunc(day, "month")


def _last(lake: Lake, name: str, key: str, first: int = 1) -> int:
    """The next number of a dense key. Each batch leaves its largest one beside the table."""
    kept = lake.read_or_none(f"{name}_last")
    if kept is not None:
        return max(first, kept.agg(F.max("last")).first()[0] + 1)
    return next_key(lake.read(name), key, first) if lake.exists(name) else first


def _note_last(lake: Lake, name: str, batch: str, key: str, before: int) -> None:
    lake.append(f"{name}_last", batch, lambda: lake.read_batch(name, batch).agg(
        F.greatest(F.max(key), F.lit(before - 1)).cast("long").alias("last")))


def _log_rejects(lake: Lake, batch: str, rows: DataFrame) -> int:
    """Adds rows that are not logged yet; earlier batches only, so retries see the same log. A
    record has one lead date, so only the months of the batch are compared."""
    months = values_of(rows, _month("lead_date")) if lake.exists(LOG) else []
    existing = lake.read_or_none(LOG, months) if months else None

    def fresh() -> DataFrame:
        return rows if existing is None else quality.new_rejects(rows, existing, narrow=True)

    def named(new: DataFrame) -> DataFrame:
        return new.withColumn("rejection_id", F.md5(F.concat_ws("|", "table_name", "rejection_reason", "rejected_hash")))

    return lake.append(LOG, batch, fresh, _month("lead_date"), late=named)


def master_step(lake: Lake, batch: str, require_consent: bool = False) -> None:
    """Staged batch → reject log, identities and master rows."""
    with logged_run(lake, "MASTER_PROSPECTS", "CORE", fv.MASTER_TABLE) as run:
        checked = quality.validate_leads(lake.read_batch("staging/leads", batch), require_consent)
        bad = quality.reject_rows(
            quality.invalid_leads(checked), fv.MASTER_TABLE, quality.LEAD_FIELDS, "PHI_LOAD", F.col("_loaded_at"),
            lead_date("file_date"),
        )
        run.rows_rejected = _log_rejects(lake, f"{batch}-core", bad)
        valid = quality.valid_leads(checked)
        keyed = valid.select(mastering.identity_key().alias("identity_key"), lead_date("file_date").alias("file_date"))
        buckets, months = values_of(keyed, lake.bucket("identity_key")), values_of(keyed, _month("file_date"))
        xref = lake.read("core/identity_xref", buckets) if lake.exists("core/identity_xref") else lake.spark.createDataFrame(
            [], "master_patient_id string, master_number bigint, identity_key string, first_name string, "
                "last_name string, email string")
        first = _last(lake, "core/identity_xref", "master_number", fv.FIRST_MASTER_NUMBER)
        lake.append("core/identity_xref", batch, lambda: mastering.resolve_identity(valid, xref, first), lake.bucket("identity_key"))
        _note_last(lake, "core/identity_xref", batch, "master_number", first)
        known = lake.read("core/identity_xref", buckets)
        master = lake.read_or_none("core/prospect_master", months)
        run.rows_loaded = lake.append(
            "core/prospect_master", batch,
            lambda: mastering.master_prospects(valid, known, master, record_ids=False), _month("file_date"),
            late=mastering.with_record_ids)


def bronze_step(lake: Lake, batch: str) -> None:
    """A record id is made of the prospect and the file date, so only its month can hold it."""
    with logged_run(lake, "APPEND_BRONZE", "BRONZE", "BRZ_PROSPECT_MASTER") as run:
        rows = lake.read_batch("core/prospect_master", batch)
        bronze = None
        if lake.exists("bronze/prospect_master"):
            bronze = lake.read_or_none("bronze/prospect_master", values_of(rows, _month("file_date")))
        # Without rows to compare with, the months lie together as the master rows do.
        run.rows_loaded = lake.append(
            "bronze/prospect_master", batch, lambda: mastering.append_bronze(rows, bronze, narrow=True), _month("file_date"),
            by_part=bronze is None)


def silver_step(lake: Lake, batch: str) -> None:
    """Bronze batch → rejects, closed versions into the history, current versions replaced.

    The chain is computed once into its own batch, because replacing current versions and
    appending to the history both depend on the same earlier ones. Only the hash buckets of the
    batch's prospects are read, and only they are written again.
    """
    with logged_run(lake, "SCD2_SILVER", "SILVER", fv.SILVER_TABLE) as run:
        bronze = lake.read_batch("bronze/prospect_master", batch)
        bucket = lake.bucket("master_patient_id")
        buckets = values_of(bronze, bucket)
        base = lake.read("silver/current", buckets) if lake.exists("silver/current") else history.empty_current(lake.spark, bronze)
        ids = base.select("record_id")
        if lake.exists("silver/history"):
            ids = ids.unionByName(lake.read("silver/history", buckets).select("record_id"))
        judged = history.silver_quality(bronze, ids)
        bad = quality.reject_rows(
            judged.filter("rejection_reason is not null"), fv.SILVER_TABLE, quality.SILVER_FIELDS, "SILVER_LOAD",
            F.col("phi_loaded_at"), F.col("file_date"),
        )
        run.rows_rejected = _log_rejects(lake, f"{batch}-silver", bad)
        good = judged.filter("rejection_reason is null").drop("rejection_reason")
        lake.append("silver/versions", batch, lambda: history.scd2_versions(base, good))
        versions = lake.read_batch("silver/versions", batch)
        lake.append("silver/history", batch, lambda: versions.filter("not is_current").drop("is_new"), bucket)
        lake.merge_parts("silver/current", batch, lambda: versions.filter("is_current").drop("is_new"), bucket)
        run.rows_loaded = versions.filter("is_new").count()


def silver(lake: Lake, buckets: list | None = None) -> DataFrame:
    """Closed and current versions together, of some buckets of prospects or all."""
    return lake.read("silver/history", buckets).unionByName(lake.read("silver/current", buckets))


def _dimension(lake: Lake, name: str, batch: str, empty: str, key: str, order: list[str], merged) -> None:
    existing = lake.read_or_none(name)
    target = lake.spark.createDataFrame([], empty) if existing is None else existing
    lake.replace(name, batch, lambda: star.with_new_keys(merged(target), key, order, next_key(target, key)))


def gold_leads_step(lake: Lake, batch: str) -> None:
    """Dimensions and the intake fact after a silver batch."""
    with logged_run(lake, "GOLD_INTAKE", "GOLD", "FACT_PROSPECT_INTAKE") as run:
        rows = lake.read_batch("silver/versions", batch).filter("is_new")
        # Only prospects of this batch need their intake span and count again.
        touched = rows.select("master_patient_id").distinct()
        bucket = lake.bucket("master_patient_id")
        buckets = values_of(rows, bucket)
        current = lake.read("silver/current", buckets)
        # Of closed versions the dimension takes dates and channels only.
        closed = lake.read("silver/history", buckets).withColumns(
            {c: F.lit(None).cast(current.schema[c].dataType) for c in star.LATEST})
        theirs = closed.unionByName(current).join(touched, "master_patient_id", "left_semi")
        if not lake.exists("gold/dim_channel"):
            lake.replace("gold/dim_channel", "seed", lambda: star.seed_channels(lake.spark))
        _dimension(lake, "gold/dim_channel", batch, "channel_key long, channel_name string, channel_category string",
                   "channel_key", ["channel_name"], lambda t: star.dim_channel(t, rows))
        _dimension(lake, "gold/dim_geography", batch,
                   "geo_key long, city string, state string, zip_code string, region string",
                   "geo_key", ["city", "state", "zip_code"], lambda t: star.dim_geography(t, rows))
        people = lake.read("gold/dim_prospect", buckets) if lake.exists("gold/dim_prospect") else lake.spark.createDataFrame(
            [], "prospect_key long, master_patient_id string, first_name string, last_name string, email string, "
                "phone_number string, age int, age_group string, city string, state string, zip_code string, "
                "patient_consent boolean, first_intake_date date, last_intake_date date, intake_count long, "
                "primary_channel string, is_active boolean")
        first = _last(lake, "gold/dim_prospect", "prospect_key")
        lake.merge_parts("gold/dim_prospect", batch, lambda: star.with_new_keys(
            star.dim_prospect(people, theirs), "prospect_key", ["master_patient_id"], first), bucket)
        _note_last(lake, "gold/dim_prospect", batch, "prospect_key", first)
        if not lake.exists("gold/dim_date"):
            lake.append("gold/dim_date", "seed", lambda: star.calendar(lake.spark))
        dates = lake.read("gold/dim_date")
        lake.append("gold/dim_date", batch, lambda: star.new_dates(rows, dates))
        facts = None
        if lake.exists("gold/fact_intake"):
            facts = lake.read_or_none("gold/fact_intake", values_of(rows, _month("file_date")))
        run.rows_loaded = lake.append("gold/fact_intake", batch, lambda: star.fact_intake(
            rows, lake.read("gold/dim_prospect", buckets), lake.read("gold/dim_channel"), lake.read("gold/dim_date"),
            lake.read("gold/dim_geography"), facts), _month("file_date"))


EXPORTS = "audit/exports"


def outbound_step(lake: Lake, batch: str, folder: str, single_file: bool = False) -> str:
    """The eligible prospects as CSV below ``folder``, once per batch; returns the export's path.

    The name, with the time of the first try, is noted before the export and its row count
    after it. A retry takes the noted name and writes over what an earlier try left there; a
    batch whose count is noted is not exported again."""
    with logged_run(lake, "EXPORT_OUTBOUND", "OUTBOUND", "SFMC_PROSPECT_OUTBOUND") as run:
        named = f"prospect_outbound_{utc_now():%Y%m%d_%H%M%S}"
        lake.append(f"{EXPORTS}_named", batch, lambda: lake.spark.createDataFrame([(batch, named)], "batch string, name string"))
        path = f"{folder.rstrip('/')}/{lake.read_batch(f'{EXPORTS}_named', batch).first()['name']}"
        if not lake.has_batch(EXPORTS, batch):
            rows = prospects.outbound_view(lake.read("gold/dim_prospect"))
            export_csv(rows, path, single_file)
            run.rows_loaded = lake.spark.read.schema(", ".join(f"{c} string" for c in rows.columns)).option("header", True).csv(path).count()
            lake.append(EXPORTS, batch, lambda: lake.spark.createDataFrame(
                [(batch, path, run.rows_loaded)], "batch string, path string, rows_exported long"))
    return path


def run_leads(lake: Lake, leads: DataFrame, batch: str, require_consent: bool = False, outbound: str | None = None) -> None:
    """Staging → core → bronze → silver → gold for one batch of staged leads, and the outbound
    export where a folder is named."""
    with logged_run(lake, "STAGE_LEADS", "STAGING", "STG_PROSPECT_INTAKE") as run:
        run.rows_loaded = lake.append("staging/leads", batch, lambda: leads)
    master_step(lake, batch, require_consent)
    bronze_step(lake, batch)
    silver_step(lake, batch)
    gold_leads_step(lake, batch)
    if outbound:
        outbound_step(lake, batch, outbound)


def run_events(lake: Lake, batch: str, since: str | None = None) -> None:
    """Job dimension, suppression log and engagement fact from the raw event tables.

    ``since`` limits the events to rows loaded at or after a time, so a regular run reads
    the newest raw batches only; without it every raw row is offered again and the natural
    key keeps out what the fact already has.
    """
    spark = lake.spark

    def raw(entity: str) -> DataFrame:
        found = lake.read_or_none(f"raw_events/{entity}")
        return empty_events(spark, entity) if found is None else found

    def recent(entity: str) -> DataFrame:
        rows = raw(entity)
        return rows if since is None else rows.filter(F.col("_loaded_at") >= F.lit(since).cast("timestamp_ntz"))

    details = raw("journey_details")
    with logged_run(lake, "DIM_JOB", "GOLD", "DIM_SFMC_JOB"):
        _dimension(lake, "gold/dim_job", batch,
                   "job_key long, job_id int, journey_type string, mapped_stage string, email_name string, "
                   "email_subject string, record_type string",
                   "job_key", ["job_id"], lambda t: star.dim_job(t, raw("job_metadata"), raw("job_detail")))
    with logged_run(lake, "LOG_SUPPRESSIONS", "GOLD", "DQ_REJECTION_LOG") as run:
        run.rows_rejected = _log_rejects(
            lake, f"{batch}-suppression", suppression.suppression_rejects(details, F.col("_loaded_at")))
    with logged_run(lake, "FACT_ENGAGEMENT", "GOLD", fv.ENGAGEMENT_TABLE) as run:
        people = lake.read_or_none("gold/dim_prospect")
        if people is None:
            people = spark.createDataFrame([], "master_patient_id string, prospect_key long")
        events = {kind: recent(entity) for kind, entity in EVENT_ENTITIES.items()}
        # A repeated event has the time it had before, so only the days of the batch are compared.
        day = F.to_date("event_timestamp")
        facts = None
        if lake.exists("gold/fact_engagement"):
            facts = lake.read("gold/fact_engagement", values_of(star.all_events(events, details), day))
        run.rows_loaded = lake.append("gold/fact_engagement", batch, lambda: star.fact_engagement(
            events, details, people, lake.read("gold/dim_job"), star.engagement_types(spark), facts), day)
