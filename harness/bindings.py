"""The driver's parquet tables in the library's column layout.

Missing values and other dirt are derived from row keys, the same way in the SQL of
`harness.oracle`. Nothing is cached: every frame is a plan over the files.
"""

from __future__ import annotations

import os
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from journeylake import fixed_values as fv
from journeylake.functions.columns import lead_date
from journeylake.operators import mastering, quality, star, suppression
from journeylake.operators.keyed import first_per_key
from journeylake.plans.journeys import WIDE_COLUMNS

# Two letters per nation key, in order.
NATION_STATES = "CTNYPAILMNOHTXFLGAVACAWAORAZCOMEMAINIAKSALARHIPRVI"

JOURNEY_NAMES = ("J01_Welcome", "J02_Nurture", "J03_Conversion", "J04_ReEngagement")
STATUS_NAMES = ("SP_LOAD_PHI_PROSPECT", "SP_LOAD_BRONZE_PROSPECT", "SP_LOAD_SILVER_PROSPECT")


def cached(method):
    """One plan object per table and instance; plans only, no rows."""
    @wraps(method)
    def wrapper(self, *args):
        key = (method.__name__, *args)
        if key not in self._plans:
            self._plans[key] = method(self, *args)
        return self._plans[key]

    return wrapper


#: The tables of a data folder.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


class Bound:
    """Lazily bound tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._plans: dict[tuple, DataFrame] = {}

    @cached
    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, f"{name}.parquet"))

    # --- leads ---------------------------------------------------------------

    @cached
    def leads_keyed(self) -> DataFrame:
        """Staged leads plus ``lead_id``, ``custkey``, ``segment`` and ``submitted`` for bindings."""
        joined = self.read("orders").join(self.read("customer"), F.expr("o_custkey = c_custkey"))
        timed = joined.withColumn("ordered", F.expr("cast(o_orderdate as timestamp_ntz)")).withColumn(
            "submitted_exact", F.expr("ordered + make_dt_interval(0, 0, 0, o_orderkey % 86400)"))
        return timed.selectExpr(
            "case when o_orderkey % 29 = 0 then '  ' else split_part(c_name, '#', 1) end as first_name",
            "case when o_orderkey % 31 <> 0 then split_part(c_name, '#', 2) end as last_name",
            "case when o_orderkey % 17 <> 0 then concat(if(o_orderkey % 5 = 0, upper(c_name), lower(c_name)), '@example.com') end as email",
            "if(o_orderkey % 23 = 0, '', cast(o_custkey as string)) as phone_number",
            "case when o_orderkey % 37 = 0 then 'n/a' when o_orderkey % 41 = 0 then concat(o_custkey % 60 + 15, '.6') "
            "else cast(o_custkey % 60 + 15 as string) end as age",
            "concat(o_custkey % 900, ' Main St') as address",
            "case when o_custkey % 3 = 0 then concat('Apt ', o_orderkey % 2) end as apartment_no",
            "if(o_custkey % 43 = 0, ' ', concat('City', o_custkey % 50)) as city",
            f"lower(substr('{NATION_STATES}', c_nationkey * 2 + 1, 2)) as state",
            "lpad(cast(o_custkey % 1000 as string), 5, '0') as zip_code",
            "case o_orderstatus when 'F' then 'TRUE' when 'O' then ' true ' else 'no' end as patient_consent",
            "o_orderpriority as channel",
            "if(o_orderkey % 3 = 0, date_format(submitted_exact, 'dd-MM-yyyy HH:mm'), "
            "date_format(submitted_exact, 'yyyy-MM-dd HH:mm:ss')) as submission_timestamp",
            "case when o_orderkey % 19 = 0 then 'bad' when o_orderkey % 7 = 1 then date_format(ordered, \"yyyy-MM-dd'T10:00:00Z'\") "
            "when o_orderkey % 7 = 2 then date_format(ordered, \"yyyy-MM-dd' 23:30:00.5+00:00'\") "
            "when o_orderkey % 7 = 3 then date_format(ordered, 'M/d/yyyy') when o_orderkey % 7 = 4 then date_format(ordered, 'dd-MMM-yyyy') "
            "when o_orderkey % 2 = 0 then date_format(ordered, 'dd-MM-yyyy') "
            "else date_format(ordered, 'yyyy-MM-dd') end as file_date",
            "o_orderkey as lead_id", "o_custkey as custkey", "c_mktsegment as segment", "ordered as submitted",
        )

    LEAD_KEYS = ("lead_id", "custkey", "segment", "submitted")

    @cached
    def leads(self) -> DataFrame:
        return self.leads_keyed().drop(*self.LEAD_KEYS)

    @cached
    def checked(self) -> DataFrame:
        return quality.validate_leads(self.leads_keyed())

    @cached
    def prospects(self) -> DataFrame:
        """Valid leads as mastered rows with the customer key as identity, smallest lead
        per (id, file date)."""
        valid = quality.valid_leads(self.checked())
        typed = mastering.typed_prospects(valid, ("lead_id", "custkey", "segment", "submitted"))
        one = first_per_key(typed, ["custkey", "file_date"], [F.col("lead_id")])
        return one.select(
            F.col("lead_id").cast("string").alias("record_id"),
            F.format_string(fv.MASTER_ID_FORMAT, "custkey").alias("master_patient_id"),
            *[c for c in typed.columns if c not in self.LEAD_KEYS],
            (F.col("submitted") + F.expr("interval 1 day")).alias("phi_loaded_at"),
            (F.col("segment") != "MACHINERY").alias("is_active"),
        )

    @cached
    def silver(self) -> DataFrame:
        """Mastered rows as version rows (every row current, as the dimension needs them)."""
        return self.prospects().withColumns({
            "eff_start_date": F.col("file_date"), "is_current": F.lit(True),
            "version_num": F.lit(1), "dq_passed": F.lit(True),
        })

    @cached
    def xref(self) -> DataFrame:
        people = quality.valid_leads(self.checked())
        return people.groupBy(
            mastering.identity_key().alias("identity_key"),
            F.format_string(fv.MASTER_ID_FORMAT, "custkey").alias("master_patient_id"),
        ).agg(
            F.min(F.trim("first_name")).alias("first_name"), F.min(F.trim("last_name")).alias("last_name"),
            F.min(F.lower(F.trim("email"))).alias("email"),
        )

    @cached
    def dim_prospect(self) -> DataFrame:
        return star.prospect_rows(self.silver())

    # --- engagement -----------------------------------------------------------

    @cached
    def fact(self) -> DataFrame:
        """Engagement fact; events whose id is a multiple of 50 have no known job key. Job ids
        are 107, 114, … 163, so that none is a stage number or a job key."""
        kind = (
            "case event_type when 'signup' then 'SENT' when 'view' then 'OPEN' when 'click' then 'CLICK' "
            "when 'error' then 'BOUNCE' else if(event_id % 5 = 0, 'SPAM', 'UNSUBSCRIBE') end"
        )
        base = self.read("events").selectExpr(
            "event_id", f"format_string('{fv.MASTER_ID_FORMAT}', user_id) as subscriber_key",
            "cast(event_id % 9 * 7 + 107 as int) as job_id", "ts as event_timestamp", f"{kind} as event_type", "value",
            "cast(get_json_object(props, '$.k') as int) as k",
        )
        return base.selectExpr(
            "event_id", "subscriber_key", "job_id", "if(event_id % 50 <> 0, cast(event_id % 9 + 1 as int), null) as job_key", "event_timestamp",
            "year(event_timestamp) * 10000 + month(event_timestamp) * 100 + day(event_timestamp) as date_key",
            "event_type", "k % 2 = 0 as is_unique", "event_type in ('UNSUBSCRIBE', 'SPAM') as is_suppressed",
            "case event_type when 'UNSUBSCRIBE' then 'UNSUBSCRIBE_EVENT' when 'SPAM' then 'SPAM_EVENT' end as suppression_reason",
            "if(event_type = 'UNSUBSCRIBE' and k % 4 <> 0, concat('reason_', k % 3), null) as reason", "value", "k",
        )

    @cached
    def jobs(self) -> DataFrame:
        return star.email_map(self.spark).groupBy("stage_number", "journey_code", "stage_name").agg(
            F.min("email_name").alias("email_name")
        ).selectExpr("stage_number as job_key", "cast(stage_number * 7 + 100 as int) as job_id", "journey_code as journey_type",
                     "stage_name as mapped_stage", "email_name")

    @cached
    def raw_events(self) -> DataFrame:
        return self.fact().select("event_type", "subscriber_key", "job_id")

    def raw_event_tables(self) -> dict[str, DataFrame]:
        """Six raw event tables (text columns and lineage) cut from the events."""
        base = self.fact().selectExpr(
            "subscriber_key", "job_id",
            "case event_id % 4 when 1 then date_format(event_timestamp, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") "
            "when 2 then date_format(event_timestamp, 'M/d/yyyy h:mm:ss a') when 3 then date_format(event_timestamp, \"yyyy-MM-dd HH:mm:ss'+02:00'\") "
            "else date_format(event_timestamp, 'yyyy-MM-dd HH:mm:ss') end as event_date",
            "'example.com' as domain", "cast(k % 2 = 0 as string) as is_unique", "concat('https://example.com/', k % 7) as url",
            "if(k % 2 = 0, 'Hard', 'Soft') as bounce_category", "concat('type', k % 3) as bounce_type", "reason",
            "'1' as account_id", "event_type as record_type", "concat('file_', event_id % 4) as _source_file_name",
            "event_id as _source_row_number", "event_timestamp as _loaded_at",
        )
        extra = {
            "SENT": ("domain",), "OPEN": ("domain", "is_unique"), "CLICK": ("domain", "is_unique", "url"),
            "BOUNCE": ("domain", "bounce_category", "bounce_type"), "UNSUBSCRIBE": ("reason",), "SPAM": (),
        }
        common = ("subscriber_key", "job_id", "event_date", "account_id", "record_type",
                  "_source_file_name", "_source_row_number", "_loaded_at")
        out = {}
        for kind, names in extra.items():
            part = base.filter(F.col("record_type") == kind).select(*common, *names)
            out[kind] = part.withColumn("complaint_type", F.lit("abuse")) if kind == "SPAM" else part
        return out

    @cached
    def unsubscribes(self) -> DataFrame:
        return self.fact().filter(F.col("event_type") == "UNSUBSCRIBE").select(
            "subscriber_key", "job_id", F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss").alias("event_date"), "reason"
        )

    @cached
    def journey_details(self) -> DataFrame:
        """Nine flags and latest dates per subscriber from SENT events; a subscriber with an
        unsubscribe carries a set flag in changing spellings."""
        latest = [f"max(event_date) filter (where sent_stage = {s[0]}) as d{s[0]}" for s in fv.STAGES]
        events = self.fact().selectExpr(
            "subscriber_key", "cast(event_timestamp as date) as event_date", "event_timestamp",
            "if(event_type = 'SENT', cast(event_id % 9 + 1 as int), null) as sent_stage",
            "event_type = 'UNSUBSCRIBE' and event_id % 9 < 2 as early_unsubscribe",
        )
        per = events.groupBy("subscriber_key").agg(
            *[F.expr(e) for e in latest],
            F.expr("count_if(early_unsubscribe) as unsubs"), F.expr("max(event_timestamp) as loaded"),
        ).withColumn("uid", F.expr("cast(substr(subscriber_key, 4) as bigint)"))
        pairs = [e for s in fv.STAGES for e in (
            f"case when uid % 11 = {s[0]} then null when d{s[0]} is not null then 'True' else 'False' end as {s[4]}_sent",
            f"cast(d{s[0]} as string) as {s[4]}_sent_date")]
        return per.selectExpr(
            "subscriber_key as prospect_id",
            "if(d2 is not null, 'True', 'False') as welcome_journey_complete",
            "if(d5 is not null, 'True', 'False') as nurture_journey_complete",
            "if(unsubs > 0, element_at(array('Yes', 'Y', 'True', '1', ' yes '), cast(uid % 5 + 1 as int)), 'False') as suppression_flag",
            *pairs,
            "concat('journey_', uid % 3) as _source_file_name", "uid as _source_row_number", "loaded as _loaded_at",
        ).select(*WIDE_COLUMNS, "_source_file_name", "_source_row_number", "_loaded_at")

    # --- reject log, snapshot, run log -------------------------------------------

    @cached
    def lead_rejects(self) -> DataFrame:
        bad = quality.invalid_leads(self.checked())
        rows = quality.reject_rows(
            bad, fv.MASTER_TABLE, {**quality.LEAD_FIELDS, "PATIENT_CONSENT": "patient_consent"}, "PHI_LOAD",
            F.col("submitted") + F.expr("interval 3 days"), lead_date("file_date"), carry=("lead_id",),
        )
        return rows.withColumn("rejection_id", F.concat(F.lit("L"), F.col("lead_id").cast("string"))).drop("lead_id")

    @cached
    def rejects(self) -> DataFrame:
        """Refused leads, suppressed prospects and fatal bounces (k a multiple of 10)."""
        flagged = suppression.suppression_rejects(self.journey_details(), F.col("_loaded_at")).withColumn(
            "rejection_id", F.concat(F.lit("S"), F.get_json_object("rejected_record", "$.PROSPECT_ID")))
        fatal_rows = self.fact().filter((F.col("event_type") == "BOUNCE") & (F.col("k") % 10 == 0)).withColumn(
            "rejection_reason", F.lit("FATAL_ERROR"))
        fatal = quality.reject_rows(
            fatal_rows, fv.ENGAGEMENT_TABLE, {"PROSPECT_ID": "subscriber_key"}, "SFMC_SEND", F.col("event_timestamp"),
            carry=("event_id",),
        ).withColumn("rejection_id", F.concat(F.lit("F"), F.col("event_id").cast("string"))).drop("event_id")
        return self.lead_rejects().unionByName(flagged).unionByName(fatal)

    @cached
    def snapshot(self) -> DataFrame:
        c = self.read("customer")
        key = F.col("c_custkey")
        inside = c.filter(key % 13 != 0).select(key.alias("id"), "c_acctbal")
        beyond = c.filter(key % 97 == 0).select((key + 1000000000).alias("id"), "c_acctbal")
        return inside.unionByName(beyond).select(
            F.format_string(fv.MASTER_ID_FORMAT, "id").alias("prospect_id"),
            F.when(F.col("id") % 2 == 0, "True").otherwise("False").alias("marketing_consent"),
            F.when(F.col("c_acctbal") > 5000, "True").otherwise("False").alias("high_engagement"),
        )

    @cached
    def runs(self) -> DataFrame:
        names = ", ".join(f"'{n}'" for n in STATUS_NAMES)
        base = self.read("orders").selectExpr(
            "*", "cast(o_orderkey % 3 + 1 as int) as at",
            "cast(o_orderdate as timestamp_ntz) + make_dt_interval(0, 0, 0, o_orderkey % 86400) as started_at",
            "case o_orderstatus when 'F' then 'SUCCESS' when 'O' then 'FAILED' else 'STARTED' end as status",
        )
        return base.selectExpr(
            "lpad(cast(o_orderkey as string), 12, '0') as run_id", f"element_at(array({names}), at) as pipeline_name",
            "element_at(array('PHI_PROSPECT_MASTER', 'BRZ_PROSPECT_MASTER', 'SLV_PROSPECT_MASTER'), at) as table_name",
            "status", "o_custkey as rows_loaded", "if(status = 'FAILED', 'load failed', null) as error_message",
            "started_at", "if(status <> 'STARTED', started_at + interval 1 minute, null) as completed_at",
        )

    # --- star pieces ---------------------------------------------------------------

    @cached
    def geography(self) -> DataFrame:
        return star.geography_rows(self.silver())

    @cached
    def calendar(self) -> DataFrame:
        return star.calendar_over(
            self.read("orders").select(F.to_date(F.col("o_orderdate").cast("timestamp_ntz")).alias("d")), "d")

    @cached
    def event_calendar(self) -> DataFrame:
        return star.calendar_over(self.read("events").select(F.to_date("ts").alias("d")), "d")

    @cached
    def intake(self) -> DataFrame:
        """Intake fact with natural keys in place of surrogate ones."""
        return self.prospects().select(
            "record_id", "master_patient_id", "submission_timestamp", "file_date", "age",
            (F.year("file_date") * 10000 + F.month("file_date") * 100 + F.dayofmonth("file_date")).alias("date_key"),
            F.when(F.col("patient_consent"), 1).otherwise(0).alias("consent_flag"),
        )
