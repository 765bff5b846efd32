"""Star schema: calendar, dimensions and the two fact tables.

Look-ups are plain left joins. Spark broadcasts a dimension when its size (known from
the files, or measured by adaptive execution) is below the session's threshold, and
otherwise sorts and splits skewed keys, so a large prospect dimension or a hot job id
needs no hint here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as fv
from ..functions.columns import blank_to_null, date_key, event_timestamp, truthy
from ..functions.labels import age_group, census_region, channel_category
from ..session import cut_lineage, fixed_table
from .keyed import assign_dense_keys, first_per_key, merge_rows, next_key, unseen


# --- calendar ---------------------------------------------------------------

def date_attributes(days: DataFrame, day: str = "full_date") -> DataFrame:
    """The eleven calendar columns of a frame of distinct days."""
    d = F.col(day)
    weekday = (F.dayofweek(d) - 1).cast("int")  # 0 = Sunday
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEE").alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
    )


def calendar(spark: SparkSession, start: str = fv.CALENDAR_START, days: int = fv.CALENDAR_DAYS) -> DataFrame:
    first = F.lit(start).cast("date")
    return date_attributes(
        spark.range(1).select(F.explode(F.sequence(first, F.date_add(first, days - 1))).alias("full_date"))
    )


def calendar_over(df: DataFrame, day: str) -> DataFrame:
    """Every day from the first to the last date of a column; one row is exploded."""
    span = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).filter("lo is not null")
    return date_attributes(span.select(F.explode(F.sequence("lo", "hi")).alias("full_date")))


def new_dates(silver: DataFrame, dim_date: DataFrame | None = None) -> DataFrame:
    days = (
        silver.filter(F.col("dq_passed") & F.col("file_date").isNotNull())
        .select(F.col("file_date").alias("full_date")).distinct()
    )
    return date_attributes(days if dim_date is None else unseen(days, dim_date, ["full_date"]))


# --- dimensions -------------------------------------------------------------

def with_new_keys(merged: DataFrame, key: str, order: list[str], first: int | None = None) -> DataFrame:
    """Numbers the rows a merge inserted (null key) after the largest assigned key."""
    merged = cut_lineage(merged)  # the merge runs once, not once for each side of the filter
    start = next_key(merged, key) if first is None else first
    added = assign_dense_keys(merged.filter(F.col(key).isNull()).drop(key), order, start, key)
    return merged.filter(F.col(key).isNotNull()).unionByName(added)


def channel_rows(silver: DataFrame) -> DataFrame:
    return (
        silver.filter(F.col("dq_passed") & blank_to_null("channel").isNotNull())
        .select(F.col("channel").alias("channel_name")).distinct()
        .withColumn("channel_category", channel_category("channel_name"))
    )


def dim_channel(dim: DataFrame, silver: DataFrame) -> DataFrame:
    return merge_rows(dim, channel_rows(silver), ["channel_name"])


def seed_channels(spark: SparkSession) -> DataFrame:
    return fixed_table(
        spark, [(i + 1, n, c) for i, (n, c) in enumerate(fv.SEED_CHANNELS)],
        "channel_key long, channel_name string, channel_category string",
    )


def geography_rows(silver: DataFrame) -> DataFrame:
    filled = [blank_to_null(c).isNotNull() for c in ("city", "state", "zip_code")]
    return (
        silver.filter(F.col("dq_passed") & reduce(Column.__and__, filled))
        .select("city", "state", "zip_code").distinct()
        .withColumn("region", census_region("state"))
    )


def dim_geography(dim: DataFrame, silver: DataFrame) -> DataFrame:
    return merge_rows(dim, geography_rows(silver), ["city", "state", "zip_code"])


PROSPECT_ATTRIBUTES = (
    "first_name", "last_name", "email", "phone_number", "age", "age_group", "city", "state",
    "zip_code", "patient_consent", "first_intake_date", "last_intake_date", "intake_count",
    "primary_channel", "is_active",
)


#: What the dimension takes from a prospect's latest current row.
LATEST = ("first_name", "last_name", "email", "phone_number", "age", "city", "state", "zip_code",
          "patient_consent", "is_active")


def prospect_rows(silver: DataFrame) -> DataFrame:
    """One row per prospect in one aggregation: latest current row, intake span, count and
    first channel. The record id breaks ties."""
    latest = F.max_by(
        F.struct(*LATEST),
        F.when(F.col("is_current"), F.struct("eff_start_date", "version_num", "record_id")),
    )
    first_channel = F.min_by(
        F.struct("channel"),
        F.struct(F.coalesce("submission_timestamp", F.lit("9999-12-31").cast("timestamp_ntz")), F.col("record_id")),
    )
    return (
        silver.filter("dq_passed")
        .groupBy("master_patient_id")
        .agg(
            latest.alias("r"),
            F.min("file_date").alias("first_intake_date"),
            F.max("file_date").alias("last_intake_date"),
            F.count(F.lit(1)).alias("intake_count"),
            first_channel.alias("c"),
        )
        .filter("r is not null")
        .select(
            "master_patient_id", "r.*", age_group("r.age").alias("age_group"),
            "first_intake_date", "last_intake_date", "intake_count",
            F.col("c.channel").alias("primary_channel"),
        )
        .select("master_patient_id", *PROSPECT_ATTRIBUTES)
    )


def dim_prospect(dim: DataFrame, silver: DataFrame) -> DataFrame:
    return merge_rows(dim, prospect_rows(silver), ["master_patient_id"])


def engagement_types(spark: SparkSession) -> DataFrame:
    return fixed_table(
        spark, [(i + 1, t, c, p) for i, (t, c, p) in enumerate(fv.ENGAGEMENT_TYPES)],
        "event_type_key long, event_type string, event_category string, is_positive boolean",
    )


def stage_map(spark: SparkSession) -> DataFrame:
    """The nine stages (fixed, nine rows)."""
    return fixed_table(
        spark, [s[:4] for s in fv.STAGES],
        "stage_number int, journey_code string, journey_name string, stage_name string",
    )


def email_map(spark: SparkSession) -> DataFrame:
    """E-mail names with their stage and journey (fixed, fourteen rows)."""
    stages = {s[0]: s[1:4] for s in fv.STAGES}
    return fixed_table(
        spark, [(name, n, *stages[n]) for name, n in fv.EMAIL_STAGES],
        "email_name string, stage_number int, journey_code string, journey_name string, stage_name string",
    )


def stage_waits(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, fv.STAGE_WAITS, "from_stage int, to_stage int, wait_days int")


def map_email_to_stage(jobs: DataFrame, email: str = "email_name") -> DataFrame:
    """Adds stage, journey and a resend flag from the e-mail name; unknown names keep nulls.
    The map is a fixed table of fourteen rows."""
    stages = email_map(jobs.sparkSession).withColumnRenamed("email_name", "_email")
    return (
        jobs.join(F.broadcast(stages), F.trim(F.col(email)) == F.col("_email"), "left")
        .drop("_email")
        .withColumn("is_resend", F.coalesce(F.rtrim(F.col(email)).endswith("_Resend"), F.lit(False)))
    )


def job_rows(metadata: DataFrame, detail: DataFrame) -> DataFrame:
    """Latest metadata and latest detail row per job, blank-safe, with journey and stage
    derived from the e-mail name where the metadata has none."""
    newest = [F.col("_loaded_at").desc(), F.col("_source_row_number").desc()]
    meta = first_per_key(
        metadata.filter("job_id is not null"), ["job_id"], newest
    ).select(
        F.col("job_id").alias("m_job"), "journey_type", "mapped_stage", "record_type",
        F.col("email_name").alias("m_name"), F.col("email_subject").alias("m_subject"),
    )
    det = first_per_key(
        detail.withColumn("d_job", F.col("job_id").try_cast("int")).filter("d_job is not null"),
        ["d_job"], newest,
    ).select("d_job", F.col("email_name").alias("d_name"), F.rtrim("email_subject").alias("d_subject"))
    both = meta.join(det, F.col("m_job") == F.col("d_job"), "full_outer").select(
        F.coalesce("m_job", "d_job").alias("job_id"),
        "journey_type", "mapped_stage",
        F.coalesce(F.nullif("m_name", F.lit("")), "d_name").alias("email_name"),
        F.coalesce(F.nullif("m_subject", F.lit("")), "d_subject").alias("email_subject"),
        F.coalesce("record_type", F.lit("JOB")).alias("record_type"),
    )
    mapped = map_email_to_stage(both)
    return mapped.select(
        "job_id",
        F.coalesce("journey_type", "journey_code").alias("journey_type"),
        F.coalesce("mapped_stage", "stage_name").alias("mapped_stage"),
        "email_name", "email_subject", "record_type",
    )


def dim_job(dim: DataFrame, metadata: DataFrame, detail: DataFrame) -> DataFrame:
    """Upsert; a job whose journey is still unknown keeps what the dimension had."""
    return merge_rows(
        dim, job_rows(metadata, detail), ["job_id"], prefer_filled=("journey_type", "mapped_stage")
    )


# --- facts ------------------------------------------------------------------

def fact_intake(
    silver: DataFrame, prospects: DataFrame, channels: DataFrame, dates: DataFrame,
    geography: DataFrame, existing: DataFrame | None = None,
) -> DataFrame:
    """New intake facts: four left look-ups, once per record id."""
    rows = silver.filter("dq_passed")
    if existing is not None:
        rows = unseen(rows, existing, ["record_id"])
    geo = geography.select(
        F.col("city").alias("g_city"), F.col("state").alias("g_state"), F.col("zip_code").alias("g_zip"), "geo_key"
    )
    return (
        # Prospects last: the small look-ups have put numbers in the place of texts by then.
        rows.join(channels.select(F.col("channel_name").alias("channel"), "channel_key"), "channel", "left")
        .join(dates.select(F.col("full_date").alias("file_date"), "date_key"), "file_date", "left")
        .join(geo, (F.col("city") == F.col("g_city")) & (F.col("state") == F.col("g_state"))
              & (F.col("zip_code") == F.col("g_zip")), "left")
        .join(prospects.select("master_patient_id", "prospect_key"), "master_patient_id", "left")
        .select(
            "record_id", "master_patient_id", "prospect_key", "channel_key", "date_key", "geo_key",
            "submission_timestamp", "file_date", "age",
            F.when(F.col("patient_consent"), 1).otherwise(0).alias("consent_flag"),
        )
    )


EVENT_COLUMNS = (
    "subscriber_key", "job_id", "event_timestamp", "event_type", "domain", "is_unique", "click_url",
    "bounce_category", "bounce_type", "reason", "account_id", "record_type", "source_file_name",
)


def _raw_event(raw: DataFrame, event_type: str) -> DataFrame:
    has = set(raw.columns)

    def pick(name: str, alias: str | None = None) -> Column:
        return (F.col(name) if name in has else F.lit(None).cast("string")).alias(alias or name)

    reason = "reason" if "reason" in has else "complaint_type"
    unique = (
        F.coalesce(F.upper("is_unique").isin(*fv.TRUTHY_FLAGS), F.lit(False))
        if "is_unique" in has else F.lit(None).cast("boolean")
    )
    return raw.select(
        "subscriber_key",
        F.col("job_id").cast("int").alias("job_id"),
        event_timestamp("event_date").alias("event_timestamp"),
        F.lit(event_type).alias("event_type"),
        pick("domain"),
        unique.alias("is_unique"),
        pick("url", "click_url"),
        pick("bounce_category"),
        pick("bounce_type"),
        pick(reason, "reason"),
        pick("account_id"),
        F.col("record_type").alias("record_type"),
        F.col("_source_file_name").alias("source_file_name"),
    )


def suppressed_prospects(journey_details: DataFrame) -> DataFrame:
    """Distinct ids with a set suppression flag."""
    return (
        journey_details.filter(truthy("suppression_flag") & blank_to_null("prospect_id").isNotNull())
        .select("prospect_id").distinct()
    )


def _suppression_events(journey_details: DataFrame) -> DataFrame:
    no_text = F.lit(None).cast("string")
    return journey_details.filter(
        truthy("suppression_flag") & blank_to_null("prospect_id").isNotNull()
    ).select(
        F.col("prospect_id").alias("subscriber_key"),
        F.lit(None).cast("int").alias("job_id"),
        F.coalesce("_loaded_at", F.current_timestamp().cast("timestamp_ntz")).alias("event_timestamp"),
        F.lit("SUPPRESSED").alias("event_type"),
        no_text.alias("domain"),
        F.lit(None).cast("boolean").alias("is_unique"),
        no_text.alias("click_url"),
        no_text.alias("bounce_category"),
        no_text.alias("bounce_type"),
        F.lit("SUPPRESSION_FLAG=YES").alias("reason"),
        no_text.alias("account_id"),
        F.lit("SUPPRESSION").alias("record_type"),
        F.col("_source_file_name").alias("source_file_name"),
    )


# The natural key of an event; columns that a type does not use are null and compare equal.
EVENT_KEY = (
    "event_type", "source_file_name", "subscriber_key", "job_id", "event_timestamp",
    "click_url", "bounce_category", "bounce_type",
)


def all_events(raw: dict[str, DataFrame], journey_details: DataFrame) -> DataFrame:
    """Six raw event tables, by event type, and the synthetic suppressions in one union."""
    parts = [_raw_event(df, event_type) for event_type, df in raw.items()]
    return reduce(DataFrame.unionByName, [*parts, _suppression_events(journey_details)])


def fact_engagement(
    raw: dict[str, DataFrame],
    journey_details: DataFrame,
    prospects: DataFrame,
    jobs: DataFrame,
    types: DataFrame,
    existing: DataFrame | None = None,
) -> DataFrame:
    """New engagement facts: six raw event tables and the synthetic suppressions in one
    union, one anti join on the natural key and one set of look-ups.

    ``raw`` maps event type to its raw table. ``types`` is the seven-row type table.
    """
    events = all_events(raw, journey_details)
    if existing is not None:
        events = unseen(events, existing, list(EVENT_KEY), narrow=True)
    flagged = suppressed_prospects(journey_details).select(
        F.col("prospect_id").alias("subscriber_key"), F.lit(True).alias("_flagged")
    )
    people = prospects.select(
        F.col("master_patient_id").alias("subscriber_key"), F.lit(True).alias("_known"), "prospect_key"
    )
    always = F.col("event_type").isin("UNSUBSCRIBE", "SPAM", "SUPPRESSED")
    by_flag = F.when(F.coalesce("_flagged", F.lit(False)), "SUPPRESSION_FLAG=YES")
    return (
        events.join(jobs.select("job_id", "job_key"), "job_id", "left")
        .join(types.select("event_type", "event_type_key"), "event_type", "left")
        .join(people, "subscriber_key", "left")
        .join(flagged, "subscriber_key", "left")
        .select(
            "subscriber_key",
            F.when(F.col("_known"), F.col("subscriber_key")).alias("master_patient_id"),
            "prospect_key", "job_key", "event_type_key",
            date_key("event_timestamp").alias("date_key"),
            *[c for c in EVENT_COLUMNS if c != "subscriber_key"],
            (always | F.coalesce("_flagged", F.lit(False))).alias("is_suppressed"),
            F.when(F.col("event_type") == "UNSUBSCRIBE", F.coalesce(by_flag, F.lit("UNSUBSCRIBE_EVENT")))
            .when(F.col("event_type") == "SPAM", F.coalesce(by_flag, F.lit("SPAM_EVENT")))
            .otherwise(by_flag).alias("suppression_reason"),
        )
    )
