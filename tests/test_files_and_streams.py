"""Readers, incremental loads, the lake and the streams on small files."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from journeylake.operators.audit import FILE_AUDIT, RUN_LOG, logged_run
from journeylake.plans import health
from journeylake.sources import files, incremental, sql_access
from journeylake.sources.lake import Lake
from journeylake.streaming import file_streams, pipeline

HEADER = "h1,h2,h3,h4,h5,h6,h7,h8,h9,h10,h11"


def put(folder, name, *lines, encoding="utf-8"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding=encoding)


def sent(n, job=1):
    return f"acc, {n},example.com,2026-01-0{n} 10:00:00,{job}, ,oyb,77,P{n},NULL,x"


def test_utf16_events_are_remapped_and_trimmed(spark, tmp_path):
    put(tmp_path / "sent", "sent_20260101_1000.csv", HEADER, sent(1), "acc,2,short", sent(3) + ",extra", encoding="utf-16")
    got = {r.batch_id: r for r in files.read_event_csv(spark, str(tmp_path / "sent"), "sent").collect()}
    r = got[1]
    assert (r.account_id, r.job_id, r.list_id, r.subscriber_id, r.subscriber_key, r.domain, r.record_type) == (
        "acc", 1, None, 77, "P1", "example.com", "SENT")
    assert r.triggered_send_customer_key is None and r.event_date == "2026-01-01 10:00:00"
    assert r._source_file_name == "sent_20260101_1000.csv"
    assert got[2].subscriber_key is None and got[3].subscriber_key == "P3"
    with pytest.raises(Exception):
        files.read_event_csv(spark, str(tmp_path / "sent"), "sent", strict=True).collect()


def test_lead_files_by_pattern(spark, tmp_path):
    line = 'Ann,Lee,"a,b@x.com",NULL,30,a,,Reno,NV,1,TRUE,Website,2026-01-02 03:04:05,2026-01-02'
    put(tmp_path / "in", "prospect_campaign_1.csv", ",".join(f"c{i}" for i in range(14)), line, "only,two")
    put(tmp_path / "in", "other.csv", "h", line)
    rows = files.read_lead_csv(spark, str(tmp_path / "in")).orderBy("first_name").collect()
    assert [(r.first_name, r.email, r.phone_number, r.apartment_no) for r in rows] == [
        ("Ann", "a,b@x.com", None, None), ("only", None, None, None)]


def test_generic_landing(spark, tmp_path):
    put(tmp_path / "act", "a.csv", "h1,h2", "x, ,z", encoding="utf-16")
    cells = files.read_generic(spark, str(tmp_path / "act")).first()["raw_row"]
    assert len(cells) == 50 and cells[:4] == ["x", None, "z", None]


def test_time_in_file_names(spark):
    names = ["a_20260102_030405.csv", "a_20260102_0304.csv", "plain.csv", "a_20260102_0304_x.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(files.file_timestamp("n").alias("t"))
    assert [r.t for r in df.collect()] == [datetime(2026, 1, 2, 3, 4, 5), datetime(2026, 1, 2, 3, 4), None, None]


def test_incremental_load_skips_loaded_and_leaves_no_rows_on_failure(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    folder = tmp_path / "in"

    def read(session, paths):
        return files.read_event_csv(session, paths, "sent", encoding="UTF-8", strict=True)

    def load(**kw):
        return incremental.load_new_files(lake, str(folder), "sent", "raw_events/sent", read, **kw)

    put(folder, "b_20260102_1000.csv", HEADER, sent(2))
    put(folder, "a_20260101_1000.csv", HEADER, sent(1))
    put(folder, "untimed.csv", HEADER, sent(3))
    # One file at a time, until none is left.
    assert load(batch_files=1) == 3 and load() == 0
    put(folder, "c_20260103_1000.csv", HEADER, "too,short")
    with pytest.raises(Exception):
        load()
    assert lake.read("raw_events/sent").count() == 3
    states = {(r.file_name, r.status): r.rows_loaded for r in lake.read(FILE_AUDIT).collect()}
    assert states[("c_20260103_1000.csv", "FAILED")] == 0 and states[("untimed.csv", "SUCCESS")] == 1
    put(folder, "c_20260103_1000.csv", HEADER, sent(4))
    assert load() == 1
    assert {r.status for r in lake.read(RUN_LOG).collect()} == {"SUCCESS", "FAILED"}


def test_a_crash_between_publishing_and_auditing_doubles_nothing(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    folder = tmp_path / "in"
    put(folder, "a_20260101_1000.csv", HEADER, sent(1))

    def load():
        return incremental.load_new_files(
            lake, str(folder), "sent", "raw_events/sent", lambda s, p: files.read_event_csv(s, p, "sent", encoding="UTF-8", strict=True))

    append = lake.append

    def broken(table, *rest):
        if table == FILE_AUDIT:
            raise KeyboardInterrupt
        return append(table, *rest)

    monkeypatch.setattr(lake, "append", broken)
    with pytest.raises(KeyboardInterrupt):
        load()
    monkeypatch.setattr(lake, "append", append)
    put(folder, "b_20260102_1000.csv", HEADER, sent(2))
    assert load() == 1 and lake.read("raw_events/sent").count() == 2
    assert lake.read(FILE_AUDIT).filter("status = 'SUCCESS' and rows_loaded = 1").count() == 2


def test_files_of_one_name_in_two_folders_are_both_loaded(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    name = "a b_20260101_1000.csv"
    put(tmp_path / "in1", name, HEADER, sent(1))
    put(tmp_path / "in2", name, HEADER, sent(2), sent(3))

    def load(folder, entity="sent"):
        return incremental.load_new_files(
            lake, str(tmp_path / folder), entity, "raw_events/sent",
            lambda s, p: files.read_event_csv(s, p, "sent", encoding="UTF-8", strict=True))

    assert load("in1") == 1 and load("in2") == 2 and load("in1") == 0 and load("in2") == 0
    assert sorted(r.batch_id for r in lake.read("raw_events/sent").collect()) == [1, 2, 3]
    # A file that another entity has loaded into the target is still new here.
    assert load("in2", "resent") == 2 and load("in2", "resent") == 0
    assert lake.read("raw_events/sent").count() == 5
    audited = lake.read(FILE_AUDIT).filter("status = 'SUCCESS'").collect()
    assert sorted((r.stage_name[-3:], r.entity_name, r.rows_loaded) for r in audited) == [("in1", "sent", 1), ("in2", "resent", 2), ("in2", "sent", 2)]


def test_lake_versions_and_retries(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert not lake.exists("t") and lake.read_or_none("t") is None
    assert lake.append("t", "b1", lambda: spark.range(3)) == 3
    assert lake.append("t", "b1", lambda: spark.range(9)) == 3
    assert lake.append("t", "b2", lambda: spark.range(2)) == 2
    assert lake.read("t").count() == 5
    (tmp_path / "lake" / "t" / "v00000001" / "half").mkdir()
    assert lake.read("t").count() == 5
    before = lake.read("t")
    assert lake.replace("t", "b3", lambda: lake.read("t").limit(1)) == 1
    assert lake.read("t").count() == 1 and before.count() == 5
    lake.compact("t", "c1", 1)
    assert Lake(spark, str(tmp_path / "lake")).read("t").count() == 1


def test_failed_run_is_logged_and_raised(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(ZeroDivisionError):
        with logged_run(lake, "JOB", "GOLD", "T"):
            1 / 0
    row = lake.read(RUN_LOG).first()
    assert row.status == "FAILED" and "ZeroDivisionError" in row.error_message


LEAD_HEADER = ",".join(f"c{i}" for i in range(14))


def lead(first, email, channel, day):
    return f"{first},Lee,{email},555,30,a,,Reno,NV,89501,TRUE,{channel},2026-01-{day:02d} 03:04:05,2026-01-{day:02d}"


def test_lead_stream_through_all_layers(spark, tmp_path):
    """Two deliveries and an empty start; then the narrated lifecycles hold."""
    lake = Lake(spark, str(tmp_path / "lake"))
    folder, checkpoint = tmp_path / "in", str(tmp_path / "cp")

    def run():
        file_streams.stream_leads(lake, str(folder), checkpoint).awaitTermination()

    put(folder, "prospect_campaign_1.csv", LEAD_HEADER, lead("Ann", "ann@x.com", "Website", 2), lead("Bo", "", "Survey", 2))
    run()
    run()
    put(folder, "prospect_campaign_2.csv", LEAD_HEADER, lead("ANN", "Ann@x.com", "Referral", 5), lead("Cy", "cy@x.com", "Radio", 5),
        lead("Bo", "", "Survey", 2))
    run()
    assert lake.read("staging/leads").count() == 5
    log = lake.read("audit/reject_log")
    assert [r.rejection_reason for r in log.collect()] == ["NULL_EMAIL"]
    xref = {r.identity_key: r.master_patient_id for r in lake.read("core/identity_xref").collect()}
    assert xref == {"ANN|LEE|ann@x.com": "FIP0000000801", "CY|LEE|cy@x.com": "FIP0000000802"}
    versions = sorted((r.master_patient_id, r.version_num, r.is_current, r.channel) for r in pipeline.silver(lake).collect())
    assert versions == [("FIP0000000801", 1, False, "Website"), ("FIP0000000801", 2, True, "Referral"), ("FIP0000000802", 1, True, "Radio")]
    people = {r.master_patient_id: r for r in lake.read("gold/dim_prospect").collect()}
    ann = people["FIP0000000801"]
    assert (ann.intake_count, ann.primary_channel, ann.first_name, people["FIP0000000802"].prospect_key) == (2, "Website", "ANN", 2)
    channels = {r.channel_name: r.channel_category for r in lake.read("gold/dim_channel").collect()}
    assert channels["Website"] == "Digital" and channels["Radio"] == "Other" and channels["Instagram"] == "Social Media"
    assert lake.read("gold/dim_geography").first()["region"] == "West"
    facts = lake.read("gold/fact_intake")
    assert facts.count() == 3 and facts.filter("prospect_key is null or channel_key is null or date_key is null or geo_key is null").count() == 0
    status = {r.step: r.status for r in health.latest_runs(lake.read(RUN_LOG)).collect()}
    assert set(status.values()) == {"NOT FOUND"}

    # Events for the mastered prospects, delivered twice.
    for entity, rows in {"sent": [sent(1).replace("P1", "FIP0000000801")], "journey_details": []}.items():
        put(tmp_path / entity, f"{entity}_20260101_1000.csv", HEADER, *rows, encoding="utf-16")
    file_streams.stream_entity(lake, str(tmp_path / "sent"), "sent", str(tmp_path / "cp-sent")).awaitTermination()
    pipeline.run_events(lake, "e1")
    pipeline.run_events(lake, "e2")
    fact = lake.read("gold/fact_engagement").collect()
    assert [(f.event_type, f.master_patient_id, f.prospect_key, f.is_suppressed) for f in fact] == [("SENT", "FIP0000000801", ann.prospect_key, False)]


def test_read_only_sql(spark):
    sql_access.register({"some_numbers": spark.range(10)})
    assert sql_access.run_sql(spark, "-- note\n select * from some_numbers", 3).count() == 3
    assert sql_access.columns_of(spark, "some_numbers") == ["id"] and sql_access.columns_of(spark, "absent_table") == []
    for text in ("drop table x", "/* x */ insert into t select 1", "create view v as select 1", "", "call p()", "with a as (select 1) insert into t select * from a"):
        with pytest.raises(ValueError):
            sql_access.run_sql(spark, text)
    for text in ("SELECT * FROM `text`.`/etc/hostname`", "select '--' as x, reflect('java.lang.System', 'nanoTime')", "select * from csv.`/tmp`",
                 "select '/*' as x, reflect('java.lang.System', 'nanoTime'), '*/' as z", "select (select java_method('java.lang.System', 'nanoTime'))",
                 "with a as (select try_reflect('java.lang.System', 'nanoTime')) select * from a", "select id from some_numbers where id in (select value from text.`/etc/hostname`)",
                 "cache table some_numbers", "set x=1", "explain select 1", "from some_numbers insert into t select id", "refresh table some_numbers"):
        with pytest.raises(ValueError):
            sql_access.run_sql(spark, text)
    assert sql_access.run_sql(spark, "select '-- insert into x' as a, 'drop table reflect(' as b, id from some_numbers where id > 3 -- ok").count() == 6
    assert sql_access.run_sql(spark, "with a as (select max(id) m from some_numbers) select n.id from some_numbers n join a on n.id = a.m").first()[0] == 9
    assert sql_access.run_sql(spark, "select x from values (1), (2) as t(x) union all select id from range(3)").count() == 5
    assert sql_access.run_sql(spark, "show tables").filter("tableName = 'some_numbers'").count() == 1
    assert [r.col_name for r in sql_access.run_sql(spark, "describe some_numbers").collect()] == ["id"]
    profile = {r.table_name: r for r in sql_access.table_profile({"some_numbers": spark.range(10), "gone": None}).collect()}
    assert profile["some_numbers"].row_count == 10 and len(profile["some_numbers"].sample) == 5 and profile["gone"].note


def test_repeats_inside_the_watermark(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    spark.range(100).select("id", (F.timestamp_seconds(F.col("id") * 60 + 1767225600)).alias("ts")).write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema("id long, ts timestamp").parquet(str(tmp_path / "ev"))
    once = file_streams.without_repeats(stream.unionByName(stream), ["id"], "ts", "1 day")
    file_streams.load_files(lake, once, "raw_events/once", str(tmp_path / "cp")).awaitTermination()
    assert lake.read("raw_events/once").count() == 100


def test_row_numbers_within_files_are_stable(spark, tmp_path):
    lines = [f"P{i},Lee,p{i}@x.org,555,30,a,,Reno,NV,89501,TRUE,Web,2026-01-01 03:04:05,2026-01-01" for i in range(5000)]
    put(tmp_path / "in", "prospect_campaign_1.csv", LEAD_HEADER, *lines)
    put(tmp_path / "in", "prospect_campaign_2.csv", LEAD_HEADER, *lines[:40])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 50_000)  # the first file is several splits
    try:
        for _ in range(2):
            rows = files.read_lead_csv(spark, str(tmp_path / "in"))
            assert rows.rdd.getNumPartitions() > 3 and "_source_block" not in rows.columns
            found = rows.select("_source_file_name", "_source_row_number", "first_name").collect()
            assert sorted((r[0], r[1]) for r in found) == [("prospect_campaign_1.csv", i + 1) for i in range(5000)] + [("prospect_campaign_2.csv", i + 1) for i in range(40)]
            assert all(r.first_name == f"P{r._source_row_number - 1}" for r in found)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    lake = Lake(spark, str(tmp_path / "lake"))
    file_streams.stream_entity(lake, str(tmp_path / "in"), "sent", str(tmp_path / "cp"), encoding="UTF-8", pattern="*1.csv").awaitTermination()
    numbers = [r._source_row_number for r in lake.read("raw_events/sent").select("_source_row_number").collect()]
    assert sorted(numbers) == list(range(1, 5001))


def test_states_of_runs_and_files(spark, tmp_path, monkeypatch):
    from journeylake.operators.audit import file_log, run_log

    lake, folder = Lake(spark, str(tmp_path / "lake")), tmp_path / "in"
    put(folder, "a_20260101_1000.csv", HEADER, sent(1))

    def load():
        return incremental.load_new_files(
            lake, str(folder), "sent", "raw_events/sent", lambda s, p: files.read_event_csv(s, p, "sent", encoding="UTF-8", strict=True))

    append = lake.append

    def dies(table, *rest):
        if table == FILE_AUDIT:
            raise KeyboardInterrupt  # between publishing and auditing
        return append(table, *rest)

    monkeypatch.setattr(lake, "append", dies)
    with pytest.raises(KeyboardInterrupt):
        load()
    assert [r.status for r in run_log(lake).collect()] == ["STARTED"] and [r.status for r in file_log(lake).collect()] == ["STARTED"]
    monkeypatch.setattr(lake, "append", append)
    load()
    assert lake.read("raw_events/sent").count() == 1
    assert [(r.status, r.rows_loaded) for r in file_log(lake).collect()] == [("SUCCESS", 1)]
    put(folder, "b_20260102_1000.csv", HEADER, "too,short")
    with pytest.raises(Exception):
        load()
    states = {r.file_name: (r.status, r.rows_loaded) for r in file_log(lake).collect()}
    assert states == {"a_20260101_1000.csv": ("SKIPPED", 0), "b_20260102_1000.csv": ("FAILED", 0)}
    # The second load looked twice: one file, then none.
    assert sorted(r.status for r in run_log(lake).collect()) == ["FAILED", "STARTED", "SUCCESS", "SUCCESS"]
