"""Raw fallbacks, traces by name, term vectors, and integrity checks that can fail."""

import datetime as dt

from test_pipeline_steps import details

from journeylake.plans import checks, dashboard, engagement, features, prospects, scoring

DAY = dt.datetime(2024, 1, 10, 8)
EVENTS = "subscriber_key string, job_id int, job_key int, date_key int, event_timestamp timestamp_ntz, event_type string, is_unique boolean"


def events(spark, *rows):
    return spark.createDataFrame([(who, job, job, 20240110, DAY, kind, False) for who, job, kind in rows], EVENTS)


def job_rows(spark):
    return spark.createDataFrame([
        (1, 1, "J01_Welcome", "Welcome Email", "Prospect_Welcome_01_Welcome_Email"),
        (2, 2, "J01_Welcome", "Education Email", "Prospect_Welcome_02_Education_Email"),
    ], "job_key int, job_id int, journey_type string, mapped_stage string, email_name string")


def test_fallbacks_follow_what_gold_holds(spark):
    raw = events(spark, ("a", 1, "SENT"), ("a", 1, "CLICK"), ("b", 1, "SENT"), ("b", 1, "OPEN"), ("c", 1, "SENT"), ("d", 1, "CLICK"))
    none, jobs, span = raw.filter("false"), job_rows(spark), ("2024-01-01", "2024-01-31")
    # Raw: the click without a send is out, the click without an open counts twice.
    assert tuple(dashboard.conversion_any(none, raw, jobs, *span).first()) == (1, 1, 2)
    assert tuple(dashboard.conversion_any(raw, none, jobs, *span).first()) == (2, 1, 2)
    log = spark.createDataFrame([], "rejection_reason string, rejected_record string, rejected_at timestamp_ntz, lead_date date")
    assert dashboard.email_kpis_any(none, raw, jobs, log, *span).first().actual == 3
    assert dashboard.email_kpis_any(raw, none, jobs, log, *span).first().actual == 3
    assert dashboard.email_kpis_any(none, raw, jobs, log, "2025-01-01", "2025-12-31").first().actual == 0
    assert engagement.engagement_pivot_any(none, raw, jobs, *span).columns == ["event_type", "cnt"]
    assert engagement.engagement_pivot_any(raw, none, jobs, *span).columns == ["event_type", "J01_Welcome"]
    assert scoring.conversion_scores_any(none, none, raw, *span).count() == 3


def test_trace_by_name_keeps_repeats(spark):
    lead = ("x@y.z", "Ann", "Lee", "web", "2024-01-10 08:00:00")
    leads = spark.createDataFrame([lead, lead, ("q@y.z", "Bob", "Ray", "web", None)], "email string, first_name string, last_name string, channel string, submission_timestamp string")
    people = spark.createDataFrame([], "master_patient_id string, email string, first_name string, last_name string, channel string, submission_timestamp timestamp_ntz")
    xref = spark.createDataFrame([("M1", "ANN|LEE|x@y.z", "x@y.z", "Ann", "Lee"), ("M1", "ANN|LEE|x@y.z", "x@y.z", "Ann", "Lee")],
                                 "master_patient_id string, identity_key string, email string, first_name string, last_name string")
    log = spark.createDataFrame([], "rejection_reason string, rejected_record string, rejected_at timestamp_ntz, lead_date date")

    def layers(who, name=None):
        return sorted(r.layer for r in prospects.trace_prospect(who, leads, log, people, xref, name).collect())

    assert layers("none@y.z", "ann lee") == ["A_Intake"] * 2
    assert layers("x@y.z", "ann") == ["A_Intake"] * 2 + ["D_Identity_Xref"] * 2
    assert layers("M1") == ["A_Intake"] * 2 + ["D_Identity_Xref"] * 2
    assert layers("M1", "bob") == ["A_Intake"] * 3 + ["D_Identity_Xref"] * 2


def test_document_vectors(spark):
    docs = spark.createDataFrame([(1, "a b a, B"), (2, None), (3, " .. "), (4, "License c")], "id long, text string")
    got = {r.id: r for r in features.document_vectors(docs, ["license"]).collect()}
    assert set(got) == {1, 4} and sum(got[1].vector) == 4 and len(got[1].vector) == 128
    assert "license" in got[4].text and "license" not in got[1].text


def test_each_integrity_check_can_fail(spark):
    jobs = job_rows(spark)
    log_schema = "rejection_reason string, rejected_record string"

    def run(fact, emails=("x@y.z",), consent=True, mastered=("x@y.z",), log=(), wide=None):
        leads = spark.createDataFrame([(e,) for e in emails], "email string")
        people = spark.createDataFrame([("P1", e, consent) for e in mastered], "master_patient_id string, email string, patient_consent boolean")
        wide = details(spark, ("P1", "False", {1: "True"}, {1: "2024-01-01"})) if wide is None else wide
        rows = checks.integrity_checks(
            leads, people, spark.createDataFrame(list(log), log_schema), fact, jobs,
            spark.createDataFrame([(20240110,)], "date_key int"),
            spark.createDataFrame([(k,) for k in ("SENT", "OPEN", "CLICK", "BOUNCE")], "event_type string"),
            spark.createDataFrame([("P1",)], "master_patient_id string"),
            wide)
        return {r.check_name for r in rows.collect() if not r.passed}

    fine = events(spark, ("P1", 1, "SENT"), ("P1", 1, "OPEN"))
    assert run(fine) == set()
    assert run(fine, consent=False) == {"no_consent_rejection"}
    assert run(fine, emails=("x@y.z", " ")) == {"intake_null_email_rejection"}
    assert run(fine, emails=("x@y.z", " "), log=[("NULL_EMAIL", '{"EMAIL":null}')]) == set()
    assert run(fine, emails=(None,), mastered=(None,)) == {"intake_null_email_rejection"}
    assert run(fine, emails=(), log=[]) == {"lead_to_prospect_balance"}
    assert run(fine, wide=details(spark, ("P1", "Yes", {1: "True"}, {1: "2024-01-01"}))) == {"suppression_observability"}
    assert run(events(spark, ("P1", 2, "SENT"))) == set()
    assert run(events(spark, ("P1", 2, "SENT")), wide=details(spark, ("P1", "False", {}))) == {"send_balance"}
    assert run(events(spark, ("P1", 1, "SENT"), ("P1", 2, "BOUNCE"))) == {"delivery_balance"}
    assert run(events(spark, ("P1", 1, "OPEN"))) == {"engagement_balance"}
    assert run(events(spark, ("P1", 1, "SENT"), ("P1", 1, "CLICK"))) == {"click_balance"}
    assert run(events(spark, ("P9", 1, "SENT"))) == {"subscriber_identity_bridge_integrity"}
    assert run(events(spark, ("P1", 7, "SENT"))) == {"job_metadata_integrity"}
