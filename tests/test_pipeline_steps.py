"""Validation, identity, history and star operators on literal rows."""

from datetime import date, datetime

from pyspark.sql import functions as F

from journeylake import fixed_values as fv
from journeylake.operators import history, mastering, quality, star, suppression
from journeylake.plans import journeys
from journeylake.sources.layouts import LEAD_COLUMNS

LEAD = dict(first_name="Ann", last_name="Lee", email="Ann@X.com", phone_number="1", age="30", address="a", apartment_no=None,
            city="Reno", state="nv", zip_code="1", patient_consent="TRUE", channel="Website",
            submission_timestamp="2026-01-02 03:04:05", file_date="2026-01-02")


def leads(spark, *changes):
    schema = ", ".join(f"{c} string" for c in LEAD_COLUMNS)
    return spark.createDataFrame([tuple({**LEAD, **c}[n] for n in LEAD_COLUMNS) for c in changes], schema)


def no_xref(spark):
    return spark.createDataFrame([], "master_patient_id string, master_number bigint, identity_key string, "
                                     "first_name string, last_name string, email string")


def test_first_failing_rule_wins(spark):
    blank = dict(first_name=" ", last_name="", email=None, phone_number="", file_date="x")
    steps, want = [], list(fv.LEAD_REJECT_REASONS) + [None]
    for i in range(6):
        steps.append(dict(list(blank.items())[i:]))
    got = [r[0] for r in quality.validate_leads(leads(spark, *steps)).select("rejection_reason").collect()]
    assert got == want


def test_consent_is_enforced_only_on_request(spark):
    df = leads(spark, dict(patient_consent="no"), {})
    assert quality.validate_leads(df).filter("rejection_reason is not null").count() == 0
    assert [r[0] for r in quality.validate_leads(df, True).select("rejection_reason").collect()] == ["NO_CONSENT", None]


def test_reject_log_is_idempotent_and_drops_null_fields(spark):
    bad = quality.invalid_leads(quality.validate_leads(leads(spark, dict(email=None), dict(phone_number=""))))
    rows = quality.reject_rows(bad, fv.MASTER_TABLE, quality.LEAD_FIELDS, "PHI_LOAD")
    assert quality.new_rejects(rows, rows).count() == 0
    texts = [r[0] for r in rows.select("rejected_record").collect()]
    assert not any("EMAIL" in t for t in texts if "NULL" in t) and all('"STAGE":"PHI_LOAD"' in t for t in texts)
    broken = spark.createDataFrame([("not json",)], "rejected_record string")
    assert quality.parsed_rejects(broken).first()["lead_date"] is None


def test_identity_ignores_case_and_continues_numbers(spark, rows):
    first = mastering.resolve_identity(leads(spark, {}, dict(first_name="ANN ", email=" ann@x.COM"), dict(first_name="Bo")), no_xref(spark))
    assert rows(first, "master_patient_id", "identity_key") == [
        ("FIP0000000801", "ANN|LEE|ann@x.com"), ("FIP0000000802", "BO|LEE|ann@x.com")]
    more = mastering.resolve_identity(leads(spark, {}, dict(first_name="Cy")), first)
    assert rows(more, "master_patient_id", "first_name") == [("FIP0000000803", "Cy")]


def test_mastering_types_and_guard(spark):
    staged = leads(spark, dict(age="12.6"), dict(channel="Survey"), dict(file_date="03-01-2026", age="x"))
    xref = mastering.resolve_identity(staged, no_xref(spark))
    got = mastering.master_prospects(staged, xref)
    assert sorted(got.select("file_date").toPandas()["file_date"]) == [date(2026, 1, 2), date(2026, 1, 3)]
    row = got.filter(F.col("file_date") == date(2026, 1, 3)).first()
    assert (row.age, row.state, row.email, row.patient_consent) == (None, "NV", "ann@x.com", True)
    assert mastering.master_prospects(staged, xref, got).count() == 0
    assert mastering.master_prospects(staged, xref, one_per_day=False).count() == 3
    again = mastering.master_prospects(staged, xref)
    assert {r[0] for r in again.select("record_id").collect()} == {r[0] for r in got.select("record_id").collect()}


VERSION_SCHEMA = ("record_id string, master_patient_id string, first_name string, last_name string, email string, phone_number string, age int, "
                  "address string, apartment_no string, city string, state string, zip_code string, patient_consent boolean, channel string, "
                  "submission_timestamp timestamp_ntz, file_date date, phi_loaded_at timestamp_ntz, is_active boolean")


def version(rid, day, pid="P1", channel="a", email="e@x", consent=True):
    at = datetime(2026, 1, day)
    return (rid, pid, "f", "l", email, "1", 30, "a", None, "c", "s", "z", consent, channel, at, date(2026, 1, day), at, True)


def bronze(spark, *versions):
    return spark.createDataFrame(list(versions), VERSION_SCHEMA)


def scd2(spark, current, *versions):
    incoming = bronze(spark, *versions)
    base = history.empty_current(spark, incoming) if current is None else current
    return history.scd2_versions(base, incoming)


def shape(df):
    return sorted((r.record_id, r.version_num, r.eff_start_date.day, str(r.eff_end_date), r.is_current) for r in df.collect())


def test_scd2_new_unchanged_and_changed(spark):
    first = scd2(spark, None, version("r1", 1))
    assert shape(first) == [("r1", 1, 1, "9999-12-31", True)]
    current = first.drop("is_new")
    same = scd2(spark, current, version("r2", 2))
    assert shape(same) == [("r1", 1, 1, "9999-12-31", True)] and same.filter("is_new").count() == 0
    changed = scd2(spark, current, version("r2", 2, channel="b"))
    assert shape(changed) == [("r1", 1, 1, "2026-01-02", False), ("r2", 2, 2, "9999-12-31", True)]


def test_scd2_null_consent_equals_false_and_email_is_folded(spark):
    assert len(shape(scd2(spark, None, version("r1", 1, consent=None), version("r2", 2, consent=False)))) == 1
    assert len(shape(scd2(spark, None, version("r1", 1, email="E@x "), version("r2", 2, email="e@x")))) == 1


def test_scd2_three_versions_in_one_batch_chain(spark):
    got = scd2(spark, None, version("r3", 9, channel="c"), version("r1", 1), version("r2", 5, channel="b"),
               version("q1", 3, pid="P2"))
    assert shape(got) == [("q1", 1, 3, "9999-12-31", True), ("r1", 1, 1, "2026-01-05", False),
                          ("r2", 2, 5, "2026-01-09", False), ("r3", 3, 9, "9999-12-31", True)]


def test_scd2_in_steps_equals_one_batch_of_single_rows(spark):
    steps = [version("r1", 1), version("r2", 5, channel="b"), version("r3", 9, channel="b"), version("r4", 12)]
    current, closed = None, []
    for v in steps:
        out = scd2(spark, current, v)
        closed += shape(out.filter("not is_current"))
        current = spark.createDataFrame(out.filter("is_current").drop("is_new").collect(), out.drop("is_new").schema)
    assert sorted(closed + shape(current)) == shape(scd2(spark, None, *steps))


def test_silver_ladder(spark):
    data = [version("r1", 1), version("r1", 2, channel="z"), version("r2", 1, email="n/a"), version("r3", 1, pid=" "),
            version("r4", 1), version("r5", 1), version("r5", 1), version("r5", 1)]
    known = spark.createDataFrame([("r4",)], "record_id string")
    judged = history.silver_quality(bronze(spark, *data), known)
    got = sorted((r.record_id, r.rejection_reason or "") for r in judged.collect())
    assert got == [("r1", ""), ("r1", "DUPLICATE_RECORD_ID_IN_BRONZE"), ("r2", "NULL_EMAIL"), ("r3", "NULL_MASTER_PATIENT_ID"),
                   ("r4", "DUPLICATE_RECORD_ID"), ("r5", ""), ("r5", "DUPLICATE_RECORD_ID_IN_BRONZE"), ("r5", "DUPLICATE_RECORD_ID_IN_BRONZE")]


def test_calendar_seed(spark):
    days = star.calendar(spark)
    assert days.count() == 1096
    row = days.filter("full_date = date '2025-01-05'").first()
    assert (row.date_key, row.day_of_week, row.day_name, row.is_weekend, row.month_name) == (20250105, 0, "Sun", True, "January")


def test_email_map(spark, rows):
    df = spark.createDataFrame([("Prospect_Nurture_01_Education_Email_1 _Resend",), ("Prospect_Conversion_02_Reminder_Email",), ("other",)], "email_name string")
    got = rows(star.map_email_to_stage(df), "stage_number", "is_resend")
    assert got == [(3, True), (7, False), (None, False)]


def test_job_dimension_keeps_known_journey(spark):
    meta = spark.createDataFrame([(1, None, None, "", "s ", "JOB", datetime(2026, 1, 1), 1)],
                                 "job_id int, journey_type string, mapped_stage string, email_name string, email_subject string, record_type string, _loaded_at timestamp_ntz, _source_row_number bigint")
    detail = spark.createDataFrame([("1", "unknown mail", "d  ", datetime(2026, 1, 1), 1), ("x", "n", "d", datetime(2026, 1, 1), 2)],
                                   "job_id string, email_name string, email_subject string, _loaded_at timestamp_ntz, _source_row_number bigint")
    dim = spark.createDataFrame([(5, 1, "J01_Welcome", "Welcome Email", None, None, "JOB")],
                                "job_key bigint, job_id int, journey_type string, mapped_stage string, email_name string, email_subject string, record_type string")
    out = star.dim_job(dim, meta, detail).collect()
    assert [(r.job_key, r.journey_type, r.email_name, r.email_subject) for r in out] == [(5, "J01_Welcome", "unknown mail", "s ")]


def journey_row(pid, flag, sent, dates=()):
    cells = []
    for i in range(9):
        cells += [sent.get(i + 1), dict(dates).get(i + 1)]
    return (pid, "False", "False", flag, *cells)


def details(spark, *items):
    return spark.createDataFrame([journey_row(*i) for i in items], ", ".join(f"{c} string" for c in journeys.WIDE_COLUMNS))


def test_stage_summary_null_flag_counts_nowhere(spark):
    df = details(spark, ("P1", "Yes", {1: "True", 2: "False"}), ("P2", "False", {1: None}))
    row = journeys.stage_send_summary(df).first()
    assert (row.total_prospects, row.sent, row.not_sent, row.suppressed) == (2, 1, 0, 1)


def test_last_stage_and_dates(spark):
    df = details(spark, ("P1", "1", {1: "True", 3: " true "}, {1: "2026-01-01", 3: "2026-01-09"}), ("P2", "Y", {}), ("P3", "no", {9: "True"}))
    unsub = spark.createDataFrame([("P1", 3, "2026-01-10 00:00:00", None)], "subscriber_key string, job_id int, event_date string, reason string")
    got = {r.prospect_id: r for r in journeys.suppressed_last_stage(df, unsub).collect()}
    assert set(got) == {"P1", "P2"}
    assert (got["P1"].last_stage_reached, got["P1"].last_email_date, got["P1"].suppression_type) == ("Stage 3 — Nurture Edu1", date(2026, 1, 9), "Unsubscribed")
    assert (got["P2"].last_stage_reached, got["P2"].last_email_date, got["P2"].last_email) == (fv.NO_STAGE, date(1900, 1, 1), None)
    between = journeys.suppressed_between_stages(df, unsub).collect()
    assert [(r.prospect_id, r.suppressed_before_stage) for r in between] == [("P1", 4)]


def test_suppression_log_and_flag(spark):
    df = details(spark, ("P1", " yes ", {}), ("P2", "False", {}), (" ", "Y", {})).withColumns({
        "_source_file_name": F.lit("f"), "_source_row_number": F.lit(1).cast("bigint"), "_loaded_at": F.lit("2026-01-01").cast("timestamp_ntz")})
    rows = suppression.suppression_rejects(df)
    assert rows.count() == 1 and quality.new_rejects(rows, rows).count() == 0
    fact = spark.createDataFrame([("P1", False, None), ("P1", True, "old"), ("P2", None, None)], "subscriber_key string, is_suppressed boolean, suppression_reason string")
    got = sorted(((r.subscriber_key, r.is_suppressed, r.suppression_reason) for r in suppression.flag_suppressed(fact, df).collect()), key=repr)
    assert got == [("P1", True, suppression.FLAG_REASON), ("P1", True, "old"), ("P2", False, None)]
