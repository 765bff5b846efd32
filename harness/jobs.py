"""Registered queries for the pipeline operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from journeylake import fixed_values as fv
from journeylake.functions.columns import lead_date
from journeylake.operators import audit, history, mastering, quality, star, suppression
from journeylake.operators.audit import FILE_AUDIT
from journeylake.operators.keyed import assign_dense_keys, first_per_key, merge_rows
from journeylake.plans import checks, features, mart, similar
from journeylake.session import scratch_path
from journeylake.sources import files, incremental, lake as lakes
from journeylake.sources.layouts import LAYOUTS, LEAD_COLUMNS
from journeylake.streaming import file_streams, pipeline

from .bindings import Bound

AS_OF = "2024-02-01"


def _as_table(b: Bound, df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back, as a stored layer is."""
    path = scratch_path(b.spark, "table")
    df.write.parquet(path)
    return b.spark.read.schema(df.schema).parquet(path)


# --- validation, identity, mastering ------------------------------------------

def _validated(b: Bound) -> DataFrame:
    return b.checked().select("lead_id", F.coalesce("rejection_reason", F.lit("VALID")).alias("outcome"))


def _consent(b: Bound) -> DataFrame:
    checked = quality.validate_leads(b.leads_keyed(), require_consent=True)
    return checked.groupBy(F.coalesce("rejection_reason", F.lit("VALID")).alias("outcome")).count().withColumnRenamed("count", "n")


def _reject_log(b: Bound) -> DataFrame:
    rows = quality.reject_rows(
        quality.invalid_leads(b.checked()), fv.MASTER_TABLE, quality.LEAD_FIELDS, "PHI_LOAD",
        F.col("submitted"), lead_date("file_date"), carry=("lead_id",))
    return rows.select("lead_id", "table_name", "rejection_reason", "rejected_record", "rejected_at", "lead_date", "rejected_hash")


def _reject_delta(b: Bound) -> DataFrame:
    rows = _reject_log(b)
    return quality.new_rejects(rows, rows.filter("rejection_reason <> 'NULL_EMAIL'")).select("lead_id", "rejection_reason")


def _no_xref(b: Bound) -> DataFrame:
    return b.spark.createDataFrame(
        [], "master_patient_id string, master_number bigint, identity_key string, first_name string, last_name string, email string")


def _resolved(b: Bound) -> DataFrame:
    return mastering.resolve_identity(quality.valid_leads(b.checked()), _no_xref(b), fv.FIRST_MASTER_NUMBER)


def _mastered(b: Bound) -> DataFrame:
    valid = quality.valid_leads(quality.validate_leads(b.leads()))
    return mastering.master_prospects(valid, _resolved(b)).drop("phi_loaded_at")


def _bronze(b: Bound) -> DataFrame:
    master = b.prospects()
    held = master.filter("state in ('NY', 'TX')")
    return mastering.append_bronze(master, held).select("record_id", "master_patient_id", "file_date", "source_layer")


# --- history ---------------------------------------------------------------------

def _dirty_bronze(b: Bound) -> DataFrame:
    """Prospects with copies, changed copies, unusable e-mails and blank ids."""
    p = _as_table(b, b.prospects())
    k = F.col("record_id").cast("bigint")
    p = p.withColumns({
        "email": F.when(k % 21 == 0, " n/a ").otherwise(F.col("email")),
        "master_patient_id": F.when(k % 33 == 0, " ").otherwise(F.col("master_patient_id")),
    })
    copies = p.filter(k % 10 == 0)
    later = p.filter(k % 15 == 0).withColumns({
        "phi_loaded_at": F.col("phi_loaded_at") + F.expr("interval 1 day"), "channel": F.lit("later")})
    return p.unionByName(copies).unionByName(copies).unionByName(later)


def _silver_quality(b: Bound) -> DataFrame:
    dirty = _dirty_bronze(b)
    ids = dirty.filter(F.col("record_id").cast("bigint") % 7 == 0).select("record_id")
    judged = history.silver_quality(dirty, ids)
    return judged.groupBy("record_id", "channel", F.coalesce("rejection_reason", F.lit("VALID")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"))


VERSION = ("record_id", "master_patient_id", "channel", "patient_consent", "eff_start_date", "eff_end_date",
           "is_current", "version_num")


def _versions(b: Bound) -> DataFrame:
    p = _as_table(b, b.prospects())
    return history.scd2_versions(history.empty_current(b.spark, p), p)


def _scd2_increment(b: Bound) -> DataFrame:
    """Rows up to 1997 first, the rest as a second batch on the resulting current table."""
    p = _as_table(b, b.prospects())
    cut = F.lit("1998-01-01").cast("date")
    first = history.scd2_versions(history.empty_current(b.spark, p), p.filter(F.col("file_date") < cut))
    current = _as_table(b, first.filter("is_current").drop("is_new"))
    return history.scd2_versions(current, p.filter(F.col("file_date") >= cut)).select(*VERSION, "is_new")


# --- merge and keys ------------------------------------------------------------------

def _merge_source(b: Bound) -> DataFrame:
    """Largest price and line count per part; parts with a key ending in 0 or 5 come in
    under new keys, so the merge keeps, updates and inserts rows."""
    li = b.read("lineitem")
    key = F.when(F.col("l_partkey") % 5 == 0, F.col("l_partkey") + 10000000).otherwise(F.col("l_partkey"))
    return li.groupBy(key.alias("p_partkey")).agg(
        F.max("l_extendedprice").alias("p_retailprice"), F.count(F.lit(1)).cast("int").alias("p_size"))


def _merge(b: Bound, **how) -> DataFrame:
    target = b.read("part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    return merge_rows(target, _merge_source(b), ["p_partkey"], **how)


def _dense_keys(b: Bound) -> DataFrame:
    orders = b.read("orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))
    return assign_dense_keys(orders, ["o_orderdate", "o_orderkey"], 801, "order_number")


# --- star ----------------------------------------------------------------------------

def _dim_channel(b: Bound) -> DataFrame:
    return star.with_new_keys(star.dim_channel(star.seed_channels(b.spark), b.silver()), "channel_key", ["channel_name"], 6)


def _dim_geography(b: Bound) -> DataFrame:
    empty = b.spark.createDataFrame([], "geo_key long, city string, state string, zip_code string, region string")
    return star.with_new_keys(star.dim_geography(empty, b.silver()), "geo_key", ["city", "state", "zip_code"], 1)


def _keyed_prospects(b: Bound) -> DataFrame:
    return assign_dense_keys(b.dim_prospect(), ["master_patient_id"], 1, "prospect_key")


def _fact_intake(b: Bound) -> DataFrame:
    silver = _as_table(b, b.silver())
    held = silver.filter("channel = '5-LOW'").select("record_id")
    return star.fact_intake(silver, _keyed_prospects(b), _dim_channel(b), b.calendar(), _dim_geography(b), held)


def _new_dates(b: Bound) -> DataFrame:
    known = b.calendar().filter("year < 1998")
    return star.new_dates(b.silver(), known)


def _job_inputs(b: Bound) -> tuple[DataFrame, DataFrame]:
    e = b.fact().join(b.jobs().select("job_id", "email_name"), "job_id")
    sent = e.filter("event_type = 'SENT'").select(
        "job_id", F.lit(None).cast("string").alias("journey_type"), F.lit(None).cast("string").alias("mapped_stage"),
        F.when(F.col("k") % 3 == 0, "").otherwise(F.col("email_name")).alias("email_name"),
        F.concat(F.lit("Subject "), F.col("k").cast("string")).alias("email_subject"), F.lit("JOB").alias("record_type"),
        F.col("event_timestamp").alias("_loaded_at"), F.col("event_id").alias("_source_row_number"))
    # Shifted ids: the first two jobs stand in one table only, and so do two more in the other.
    opened = e.filter("event_type = 'OPEN'").select(
        F.when(F.col("k") % 5 == 0, "x").otherwise((F.col("job_id") + 14).cast("string")).alias("job_id"), "email_name",
        F.concat(F.lit("Detail "), F.col("k").cast("string"), F.lit("  ")).alias("email_subject"),
        F.col("event_timestamp").alias("_loaded_at"), F.col("event_id").alias("_source_row_number"))
    return sent, opened


def _dim_job(b: Bound) -> DataFrame:
    empty = b.spark.createDataFrame(
        [], "job_key long, job_id int, journey_type string, mapped_stage string, email_name string, email_subject string, record_type string")
    return star.with_new_keys(star.dim_job(empty, *_job_inputs(b)), "job_key", ["job_id"], 1)


def _engagement_fact(b: Bound) -> DataFrame:
    people = b.dim_prospect().select(
        "master_patient_id", F.substring("master_patient_id", 4, 10).cast("bigint").alias("prospect_key"))
    jobs = b.jobs().filter("job_key <> 9").select("job_id", "job_key")
    return star.fact_engagement(b.raw_event_tables(), b.journey_details(), people, jobs, star.engagement_types(b.spark))


def _engagement_increment(b: Bound) -> DataFrame:
    """A second load after the files 0 and 1 are in the fact already."""
    whole = _engagement_fact(b)
    held = whole.filter("source_file_name in ('file_0', 'file_1', 'journey_0')")
    people = b.dim_prospect().select("master_patient_id", F.lit(0).cast("bigint").alias("prospect_key"))
    fresh = star.fact_engagement(
        b.raw_event_tables(), b.journey_details(), people, b.jobs().select("job_id", "job_key"),
        star.engagement_types(b.spark), held)
    return fresh.groupBy("event_type", "source_file_name", "is_suppressed", "suppression_reason").agg(F.count(F.lit(1)).alias("n"))


def _log_suppressions(b: Bound) -> DataFrame:
    rows = suppression.suppression_rejects(b.journey_details(), F.col("_loaded_at"))
    return rows.select("table_name", "rejection_reason", "rejected_record", "rejected_at")


def _flag(b: Bound) -> DataFrame:
    return suppression.flag_suppressed(b.fact(), b.journey_details()).select(
        "event_id", "subscriber_key", "is_suppressed", "suppression_reason")


# --- mart, checks, features, similarity --------------------------------------------------

def _mart(b: Bound) -> DataFrame:
    return mart.journey_mart(b.intake(), b.fact(), b.jobs(), b.dim_prospect(), b.geography())


def _checks(b: Bound) -> DataFrame:
    return checks.integrity_checks(
        b.leads(), b.prospects(), b.rejects(), b.fact(), b.jobs(), b.event_calendar(), star.engagement_types(b.spark), b.dim_prospect(),
        b.journey_details())


def _features(b: Bound) -> DataFrame:
    return features.prospect_360_features(b.dim_prospect(), b.fact(), AS_OF)


def _embeddings(b: Bound) -> DataFrame:
    return b.read("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label").cast("string").alias("text"))


def _documents(b: Bound) -> DataFrame:
    """Term vectors of all documents; candidates contain a keyword (case folded, whole text)."""
    words = ["error", "LICENSE", "the "]
    texts = b.read("documents").select(F.col("doc_id").alias("id"), "text")
    return similar.similar_entities(features.document_vectors(texts, words), [1, 2, 3], 5, words)


def _documents_hybrid(b: Bound) -> DataFrame:
    """Term vectors and an inverted index of all whole documents, mixed half and half."""
    texts = b.read("documents").select(F.col("doc_id").alias("id"), "text")
    index = _as_table(b, similar.term_index(texts).sortWithinPartitions("term"))
    # Stored, because the vectors are also counted and looked up.
    vectors = _as_table(b, features.document_vectors(texts).drop("text"))
    return similar.hybrid_entities(vectors, [1, 2, 3], ["License", "copy of the software"], 10, index=index)


def _indexed(b: Bound, entities: DataFrame, query_ids: list, k: int) -> DataFrame:
    """Neighbours from an index written by cell and read back."""
    index, pivots = similar.pivot_index(entities, 16)
    path = scratch_path(b.spark, "pivot-index")
    index.write.partitionBy("cell").parquet(path)
    stored = b.spark.read.schema(index.schema).parquet(path)
    return similar.indexed_neighbours(stored, _as_table(b, pivots), query_ids, k)


# --- files and streams ----------------------------------------------------------------------

def _lead_csv(b: Bound) -> DataFrame:
    folder = scratch_path(b.spark, "leads")
    files.export_csv(b.leads(), folder)
    return files.read_lead_csv(b.spark, folder, pattern="*.csv").select(*LEAD_COLUMNS)


def _sent_export(b: Bound) -> DataFrame:
    """SENT events in the column order of the export files."""
    at = dict((position, name) for name, position in LAYOUTS["sent"].columns if isinstance(position, int))
    sent = b.raw_event_tables()["SENT"].withColumn("batch_id", F.col("job_id") + 100)
    return sent.select(*[
        (F.col(at[i]).cast("string") if at[i] in sent.columns else F.lit("NULL")).alias(f"h{i}") for i in range(1, 12)])


def _event_csv(b: Bound) -> DataFrame:
    folder = scratch_path(b.spark, "sent")
    files.export_csv(_sent_export(b), folder, encoding="UTF-16")
    return files.read_event_csv(b.spark, folder, "sent").select(
        "account_id", "job_id", "batch_id", "list_id", "subscriber_key", "event_date", "domain", "record_type")


def _load_new_files(b: Bound) -> DataFrame:
    """Two runs over a growing folder: the second loads only what is new."""
    folder = scratch_path(b.spark, "incoming")
    lake = lakes.Lake(b.spark, scratch_path(b.spark, "lake"))

    def read(spark, paths):
        return files.read_event_csv(spark, paths, "sent", encoding="UTF-8")

    export = _sent_export(b)
    files.export_csv(export.filter("h5 <= 4"), folder)
    incremental.load_new_files(lake, folder, "sent", "raw_events/sent", read)
    (export.filter("h5 > 4").write.mode("append").option("header", True).csv(folder))
    incremental.load_new_files(lake, folder, "sent", "raw_events/sent", read)
    incremental.load_new_files(lake, folder, "sent", "raw_events/sent", read)
    audited = lake.read(FILE_AUDIT).agg(F.sum("rows_loaded").alias("n")).scalar()
    return lake.read("raw_events/sent").select(
        "account_id", "job_id", "batch_id", "subscriber_key", "event_date", "domain", "record_type").withColumn("audited_rows", audited)


def _stream_events(b: Bound) -> DataFrame:
    """The event file as a stream into the lake, started twice."""
    lake = lakes.Lake(b.spark, scratch_path(b.spark, "lake"))
    checkpoint = scratch_path(b.spark, "checkpoint")
    schema = b.read("events").schema
    for _ in range(2):
        stream = b.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(b.folder)
        file_streams.load_files(lake, stream, "raw_events/all", checkpoint).awaitTermination()
    return lake.read("raw_events/all").select("event_id", "event_type", "user_id", "ts", "value", "props")


def _stream_repeats(b: Bound) -> DataFrame:
    """Every event delivered twice in one stream; repeats dropped inside the watermark."""
    lake = lakes.Lake(b.spark, scratch_path(b.spark, "lake"))
    source = b.spark.readStream.schema(b.read("events").schema).option("pathGlobFilter", "events.parquet").parquet(b.folder)
    timed = source.withColumn("ts", F.col("ts").cast("timestamp"))
    once = file_streams.without_repeats(timed.unionByName(timed), ["event_id"], "ts", "60 days")
    file_streams.load_files(lake, once, "raw_events/once", scratch_path(b.spark, "checkpoint")).awaitTermination()
    return lake.read("raw_events/once").select(
        "event_id", "event_type", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value", "props")


def _stream_late(b: Bound) -> DataFrame:
    """Every second event, then all of them: repeats fall away, late ones lie beside the table."""
    lake = lakes.Lake(b.spark, scratch_path(b.spark, "lake"))
    checkpoint, folder = scratch_path(b.spark, "checkpoint"), scratch_path(b.spark, "drops")
    events = b.read("events")
    for part in (events.filter("event_id % 2 = 0"), events):
        part.write.mode("append").parquet(folder)
        stream = b.spark.readStream.schema(events.schema).parquet(folder)
        file_streams.load_events_once(lake, stream, "raw_events/all", ["event_id"], "ts", "10 days", checkpoint).awaitTermination()
    tables = [lake.read(name).withColumn("is_late", F.lit(late)) for name, late in (("raw_events/all", False), ("raw_events/all_late", True))]
    return tables[0].unionByName(tables[1]).select("event_id", "ts", "user_id", "value", "is_late")


def _pipeline(b: Bound) -> DataFrame:
    """Two lead batches through every layer; the gold facts with their dimensions."""
    lake = lakes.Lake(b.spark, scratch_path(b.spark, "lake"))
    leads = b.leads_keyed().withColumns({
        "_source_path": F.lit("p"), "_source_file_name": F.lit("f"), "_source_row_number": F.col("lead_id"),
        "_loaded_at": F.col("submitted") + F.expr("interval 1 day")})
    early = F.col("submitted") < F.lit("1998-01-01").cast("timestamp_ntz")
    keep = [c for c in leads.columns if c not in Bound.LEAD_KEYS]
    pipeline.run_leads(lake, leads.filter(early).select(*keep), "b1")
    pipeline.run_leads(lake, leads.filter(~early).select(*keep), "b2")
    facts = lake.read("gold/fact_intake")
    people = lake.read("gold/dim_prospect").select("prospect_key", "email", "intake_count", "primary_channel")
    channels = lake.read("gold/dim_channel")
    return facts.join(people, "prospect_key").join(channels, "channel_key").select(
        "email", "channel_name", "channel_category", "file_date", "age", "consent_flag", "intake_count", "primary_channel")


def _event_chain(b: Bound) -> DataFrame:
    """Two deliveries of raw events, the second with half of the first again, through the gold steps."""
    lake = lakes.Lake(b.spark, scratch_path(b.spark, "lake"))
    people = b.dim_prospect().select("master_patient_id", F.substring("master_patient_id", 4, 10).cast("bigint").alias("prospect_key"))
    lake.merge_parts("gold/dim_prospect", "b0", lambda: people, lake.bucket("master_patient_id"))
    lake.append("raw_events/journey_details", "b0", lambda: b.journey_details())
    names = {kind: f"raw_events/{entity}" for kind, entity in pipeline.EVENT_ENTITIES.items()}
    for batch, rule in (("b1", "_source_row_number % 4 < 2"), ("b2", "_source_row_number % 4 > 0")):
        for kind, rows in b.raw_event_tables().items():
            lake.append(names[kind], batch, lambda rows=rows: rows.filter(rule))
        pipeline.run_events(lake, batch)
    return lake.read("gold/fact_engagement").groupBy(
        "event_type", "is_suppressed", "suppression_reason", F.col("master_patient_id").isNotNull().alias("known")).agg(
        F.count(F.lit(1)).alias("events"))


def _run_log(b: Bound) -> DataFrame:
    """States of the runs and rows of a load, a load without news and one that fails. A load looks
    for files until there are none, and every look is a run: two in the first load, one in the second."""
    folder, lake = scratch_path(b.spark, "incoming"), lakes.Lake(b.spark, scratch_path(b.spark, "lake"))
    files.export_csv(_sent_export(b), folder)

    def load(fails: bool) -> None:
        def read(spark, paths):
            rows = files.read_event_csv(spark, paths, "sent", encoding="UTF-8")
            return rows.withColumn("account_id", F.raise_error(F.lit("broken file"))) if fails else rows
        incremental.load_new_files(lake, folder, "sent", "raw_events/failing" if fails else "raw_events/sent", read)

    load(False)
    load(False)
    try:
        load(True)
    except Exception:  # the log is what the query shows
        pass
    files_seen = audit.file_log(lake).groupBy("target_table_name", "status").agg(F.countDistinct("status").alias("file_states"))
    return audit.run_log(lake).groupBy(F.col("table_name").alias("target_table_name"), "status").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("rows_loaded").alias("rows_loaded")).unionByName(
        files_seen.select("target_table_name", F.concat(F.lit("file "), "status").alias("status"),
                          F.col("file_states").alias("runs"), F.lit(None).cast("long").alias("rows_loaded")))


def _outbound_export(b: Bound) -> DataFrame:
    """The export of a batch, tried twice, read back."""
    lake, folder = lakes.Lake(b.spark, scratch_path(b.spark, "lake")), scratch_path(b.spark, "outbound")
    lake.merge_parts("gold/dim_prospect", "b1", lambda: b.dim_prospect(), lake.bucket("master_patient_id"))
    paths = {pipeline.outbound_step(lake, "b1", folder) for _ in range(2)}
    noted = lake.read(pipeline.EXPORTS).agg(F.sum("rows_exported").alias("n")).scalar()
    back = b.spark.read.option("header", True).schema("master_patient_id string, first_name string, last_name string, email string").csv(sorted(paths))
    return back.select("master_patient_id", "email").withColumn("rows_noted", noted)


JOBS: dict[str, Callable[[Bound], DataFrame]] = {
    "validate_leads": _validated,
    "validate_leads_consent": _consent,
    "reject_log": _reject_log,
    "reject_log_delta": _reject_delta,
    "reject_totals": lambda b: quality.reject_totals(b.lead_rejects()),
    "resolve_identity": _resolved,
    "master_prospects": _mastered,
    "append_bronze": _bronze,
    "silver_quality": _silver_quality,
    "scd2_silver": lambda b: _versions(b).select(*VERSION),
    "scd2_increment": _scd2_increment,
    "merge_upsert": _merge,
    "merge_insert_only": lambda b: _merge(b, update=()),
    "assign_keys": _dense_keys,
    "first_per_key": lambda b: first_per_key(
        b.read("lineitem"), ["l_suppkey"],
        [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")], 3,
    ).select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice"),
    "calendar": lambda b: b.calendar(),
    "dim_date_increment": _new_dates,
    "dim_channel": _dim_channel,
    "dim_geography": _dim_geography,
    "dim_prospect": lambda b: b.dim_prospect(),
    "fact_intake": _fact_intake,
    "dim_job": _dim_job,
    "fact_engagement": _engagement_fact,
    "fact_engagement_increment": _engagement_increment,
    "log_suppressions": _log_suppressions,
    "flag_suppressed": _flag,
    "journey_mart": _mart,
    "journey_mart_summary": lambda b: mart.mart_counts(b.intake(), b.fact(), b.jobs(), b.dim_prospect(), b.geography()),
    "integrity_checks": _checks,
    "prospect_360_features": _features,
    "send_time_features": lambda b: features.send_time_features(b.fact()),
    "send_time_profile": lambda b: features.send_time_profile(b.fact()),
    "signal_trust": lambda b: features.signal_trust(b.dim_prospect(), b.fact(), b.rejects()),
    "similar_embeddings": lambda b: similar.similar_entities(_embeddings(b), [0, 7, 42], 10),
    "similar_documents": _documents,
    "similar_prospects": lambda b: similar.similar_entities(
        features.prospect_vectors(_features(b)), ["FIP0000000007", "FIP0000000011"], 10),
    "similar_journeys": lambda b: similar.similar_entities(
        features.journey_stage_vectors(_mart(b)), ["J02_Nurture|Education Email 2"], 5, ["Nurture", "Conversion"]),
    "similar_rejections": lambda b: similar.similar_entities(
        features.rejection_vectors(b.rejects()), ["PHI_PROSPECT_MASTER|NULL_EMAIL|5-LOW"], 5),
    "similar_engagement": lambda b: similar.similar_entities(
        features.engagement_vectors(b.fact()), ["FIP0000000003", "FIP0000000009"], 10),
    "similar_documents_hybrid": _documents_hybrid,
    "similar_journeys_hybrid": lambda b: similar.hybrid_entities(
        features.journey_stage_vectors(_mart(b)), ["J02_Nurture|Education Email 2"], ["Nurture", "Conversion"], 5, 0.25),
    "similar_embeddings_indexed": lambda b: _indexed(b, _embeddings(b), [0, 7, 42], 10),
    "similar_engagement_indexed": lambda b: _indexed(
        b, features.engagement_vectors(b.fact()), ["FIP0000000003", "FIP0000000009"], 10),
    "read_lead_csv": _lead_csv,
    "read_event_csv": _event_csv,
    "load_new_files": _load_new_files,
    "stream_event_load": _stream_events,
    "stream_without_repeats": _stream_repeats,
    "stream_late_events": _stream_late,
    "leads_through_layers": _pipeline,
    "events_through_layers": _event_chain,
    "outbound_export": _outbound_export,
    "run_log": _run_log,
}
