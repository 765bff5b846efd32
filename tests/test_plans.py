"""Edge cases of the plans on literal rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from harness import registry
from journeylake.operators import star
from journeylake.plans import adhoc, engagement, features, outbound, prospects, rejections, scoring, similar

LOG = "table_name string, rejection_reason string, rejected_record string, rejected_at timestamp_ntz"
FACT = ("subscriber_key string, job_id int, job_key int, event_type string, event_timestamp timestamp_ntz, is_unique boolean, "
        "is_suppressed boolean, suppression_reason string")


def fact(spark, *events):
    return spark.createDataFrame(
        [(s, j, j, t, datetime(2026, 1, d), True, False, None) for s, j, t, d in events], FACT)


def people(spark, *ids, active=True):
    return spark.createDataFrame(
        [(i, "f", "l", f"{i}@x", "Web", date(2026, 1, 1), active, True) for i in ids],
        "master_patient_id string, first_name string, last_name string, email string, channel string, file_date date, "
        "is_active boolean, patient_consent boolean")


def log(spark):
    at = datetime(2026, 1, 9)
    return spark.createDataFrame([
        ("M", "NULL_PHONE_NUMBER", '{"EMAIL":"b@x","FILE_DATE":"2026-01-02"}', at),
        ("M", "NULL_PHONE_NUMBER", '{"EMAIL":"a@x","FILE_DATE":"02-01-2026"}', at),
        ("M", "NULL_PHONE_NUMBER", '{"EMAIL":"a@x","FILE_DATE":"2026-01-02"}', at),
        ("M", "NULL_EMAIL", '{"FILE_DATE":"bad"}', at),
        ("F", "Suppressed_Prospect", '{"PROSPECT_ID":"P1"}', at),
    ], LOG)


def test_rejection_groups_and_emails(spark):
    def take(**kw):
        out = rejections.rejection_analysis(log(spark), "2026-01-01", "2026-01-31", **kw).collect()
        return {r.rejection_reason: (r.lead_file_date, r.rejected_count, r.emails) for r in out}

    got = take()
    assert got["NULL_PHONE_NUMBER"] == (date(2026, 1, 2), 3, 2)
    assert got["NULL_EMAIL"] == (date(2026, 1, 9), 1, 0)
    assert set(take(category="sfmc")) == {"Suppressed_Prospect"}
    assert "Suppressed_Prospect" not in take(category="intake") and len(take(limit=1)) == 1 and take(limit=None) == got
    assert rejections.rejection_emails(log(spark), "2026-01-01", "2026-01-31").count() == 2


def test_no_email_of_a_large_group_is_lost(spark):
    at = log(spark).first()["rejected_at"]
    rows = [("M", "NULL_PHONE_NUMBER", '{"EMAIL":"%d@x","FILE_DATE":"2026-01-02"}' % i, at) for i in range(1500)]
    large = spark.createDataFrame(rows, LOG)
    assert rejections.rejection_analysis(large, "2026-01-01", "2026-01-31").first()["emails"] == 1500
    assert rejections.rejection_emails(large, "2026-01-01", "2026-01-31").count() == 1500


def test_date_filter_binds_to_every_condition(spark):
    out = rejections.rejection_analysis(log(spark), "2026-01-01", "2026-01-03", reason="NULL_EMAIL")
    assert out.count() == 0


def test_scores_without_sends_are_null_and_capped(spark):
    f = fact(spark, ("P1", 1, "CLICK", 2), ("P2", 1, "SENT", 2), *[("P2", 1, "CLICK", 3)] * 5)
    got = {r.master_prospect_id: r for r in scoring.conversion_scores(people(spark, "P1", "P2"), f, "2026-01-01", "2026-01-31").collect()}
    assert got["P1"].conversion_signal_score is None and got["P1"].engagement_rate_pct is None
    assert got["P2"].conversion_signal_score == 100.0 and got["P2"].dropoff_risk_score == 0.0
    assert scoring.conversion_scores(people(spark, "P1", active=False), f, "2026-01-01", "2026-01-31").count() == 0


def test_raw_scores_count_distinct_jobs(spark):
    raw = fact(spark, ("P1", 1, "SENT", 1), ("P1", 1, "SENT", 2), ("P1", 2, "SENT", 2), ("P1", 1, "OPEN", 3), ("P2", 1, "OPEN", 3))
    got = scoring.raw_engagement_scores(raw).collect()
    assert [(r.subscriber_key, r.total_sends, r.total_opens, r.open_rate_pct) for r in got] == [("P1", 2, 1, 50.0)]


def test_fallback_to_raw_events(spark):
    f = fact(spark, ("P1", 1, "SENT", 1))
    jobs = star.email_map(spark).limit(1).selectExpr("1 as job_id", "1 as job_key", "'J' as journey_type", "'S' as mapped_stage")
    gold = engagement.engagement_stats_any(f, f, jobs, "2026-01-01", "2026-01-31")
    raw = engagement.engagement_stats_any(f, f, jobs, "2020-01-01", "2020-01-31")
    assert "first_event" in gold.columns and "unique_subscribers" in raw.columns
    assert engagement.of_journey(f, jobs, "J02 - Nurture").count() == 0 and engagement.of_journey(f, jobs, "All").count() == 1


def test_reconciliation_counts_distinct_ids(spark):
    snap = spark.createDataFrame([("P1", "True", "True"), ("P1", "True", "True"), ("P9", "True", "False")],
                                 "prospect_id string, marketing_consent string, high_engagement string")
    dim = people(spark, "P1", "P2").withColumn("primary_channel", F.lit("Web")).withColumn("first_intake_date", F.col("file_date"))
    assert tuple(outbound.outbound_reconciliation(dim, snap).first()) == (2, 2, 1, 1, 1)
    assert [r.master_patient_id for r in outbound.outbound_missing(dim, snap).collect()] == ["P2"]
    row = outbound.outbound_engagement(dim, snap, fact(spark, ("P1", 1, "SENT", 1))).collect()
    assert [(r.master_patient_id, r.total_sends, r.open_rate_pct) for r in row] == [("P1", 2, 0.0)]


def test_outbound_eligibility(spark):
    base = people(spark, "P1").withColumns({c: F.lit(None).cast("string") for c in prospects.OUTBOUND_COLUMNS if c not in (
        "master_patient_id", "first_name", "last_name", "email", "patient_consent")})
    for change, n in [({}, 1), ({"email": F.lit(" n/a ")}, 0), ({"email": F.lit(" ")}, 0), ({"is_active": F.lit(False)}, 0), ({"patient_consent": F.lit(None).cast("boolean")}, 0)]:
        assert prospects.outbound_view(base.withColumns(change) if change else base).count() == n


def test_days_without_intake(spark):
    df = spark.createDataFrame([(date(2026, 1, 1),), (date(2026, 1, 4),)], "file_date date")
    assert sorted(r.day.day for r in adhoc.days_without_intake(df).collect()) == [2, 3]


def test_similar_entities_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    m = rng.normal(size=(60, 8))
    m[7] = 0.0
    df = spark.createDataFrame([(i, [float(x) for x in v], "even" if i % 2 == 0 else "odd") for i, v in enumerate(m)], "id long, vector array<double>, text string")
    norms = np.linalg.norm(m, axis=1)

    def brute(q, keep):
        scores = [(round(float(m[q] @ m[i] / norms[q] / norms[i]), 6), i) for i in range(60) if i != q and norms[i] > 0 and keep(i)]
        return [i for _, i in sorted(scores, key=lambda t: (-t[0], t[1]))[:4]]

    def found(**kw):
        rows = similar.similar_entities(df, [3, 10, 10], 4, **kw).collect()
        return {q: [r.id for r in sorted((r for r in rows if r.query_id == q), key=lambda r: (-r.score, r.id))] for q in (3, 10)}

    assert found() == {q: brute(q, lambda i: True) for q in (3, 10)}
    assert found(keywords=["EVEN"]) == {q: brute(q, lambda i: i % 2 == 0) for q in (3, 10)}
    # More queries than one block holds.
    many = df.union(df.selectExpr("id + 1000", "vector", "text")).union(df.selectExpr("id + 2000", "vector", "text"))
    many = many.union(df.selectExpr("id + 3000", "vector", "text")).union(df.selectExpr("id + 4000", "vector", "text"))
    ids = [r.id for r in many.collect()]
    assert similar.similar_entities(many, ids, 1).count() == 5 * 59


def test_hybrid_entities_against_brute_force(spark):
    import math

    import numpy as np

    rng = np.random.default_rng(6)
    m = rng.normal(size=(40, 6))
    m[5] = 0.0
    texts = ["Welcome journey", "no-consent NO consent", "Conversion", "", None, "welcome", "Conversion welcome conversion", "émail"] * 5
    df = spark.createDataFrame([(i, [float(x) for x in v], t) for i, (v, t) in enumerate(zip(m, texts))], "id long, vector array<double>, text string")
    found = {(r.term, r.id): r.n for r in similar.term_index(df).collect()}
    assert found["consent", 1] == 2 and found["conversion", 6] == 2 and ("émail", 7) in found and not any(i in (3, 4) for _, i in found)

    def brute(q, words, weight, k=6):
        holders = {w: [i for (t, i) in found if t == w] for w in words}
        rare = {w: math.log(1 + (40 - len(h) + 0.5) / (len(h) + 0.5)) for w, h in holders.items() if h}
        rows = []
        for i in range(40):
            if i == q or not m[i].any():
                continue
            kw = sum(r * found.get((w, i), 0) / (found.get((w, i), 0) + 1) for w, r in rare.items()) / (sum(rare.values()) or 1)
            cos = float(m[q] @ m[i] / np.linalg.norm(m[q]) / np.linalg.norm(m[i]))
            rows.append((-round((1 - weight) * cos + weight * kw, 6), i))
        return [i for _, i in sorted(rows)[:k]]

    for words, weight in ((["Welcome", "CONVERSION"], 0.5), (["no consent"], 0.9), (["absent"], 0.5), ([], 0.3)):
        rows = similar.hybrid_entities(df, [2, 9, 5, 99], words, 6, weight).collect()
        terms = sorted({w for k in words for w in k.lower().split()})
        for q in (2, 9):
            got = [r.id for r in sorted((r for r in rows if r.query_id == q), key=lambda r: (-r.score, r.id))]
            assert got == brute(q, terms, weight), (words, q)
        # One without direction, one that isn't there.
        assert {r.query_id for r in rows} == {2, 9}
    stored = similar.hybrid_entities(df.drop("text"), [2], ["welcome"], 6, index=similar.term_index(df)).collect()
    assert [r.id for r in sorted(stored, key=lambda r: (-r.score, r.id))] == brute(2, ["welcome"], 0.5)


def test_indexed_neighbours_equal_the_scan_and_read_less(spark, tmp_path, rows):
    import numpy as np

    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16))
    m = centres[rng.integers(0, 12, 3000)] + rng.normal(scale=0.05, size=(3000, 16))
    m[17] = 0.0
    m[18:22] = m[18]
    data = [(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(5000, [float("nan")] * 16), (5001, None)]
    df = spark.createDataFrame(data, "id long, vector array<double>")
    index, pivots = similar.pivot_index(df, 12, sample_rows=500)
    index.write.partitionBy("cell").parquet(str(tmp_path / "index"))
    pivots.write.parquet(str(tmp_path / "pivots"))
    index, pivots = spark.read.parquet(str(tmp_path / "index")), spark.read.parquet(str(tmp_path / "pivots"))
    assert index.count() == 2999
    finite = df.filter("id < 5000")
    wanted = [1, 17, 19, 400, 9999]
    assert rows(similar.indexed_neighbours(index, pivots, wanted, 10)) == rows(similar.similar_entities(finite, wanted, 10))
    read = similar._reachable(index, pivots, [1], 10, 6)
    assert read.count() < 600
    scan = read._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters" in scan and "cell" in scan.split("PartitionFilters")[1].splitlines()[0]
    # More neighbours asked for than the nearest cell holds, and none at all.
    assert rows(similar.indexed_neighbours(index, pivots, [1], 2000)) == rows(similar.similar_entities(finite, [1], 2000))
    none = similar.pivot_index(df.limit(0))
    assert similar.indexed_neighbours(*none, [1]).count() == 0 and similar.indexed_neighbours(index, pivots, []).count() == 0


def test_indexed_neighbours_where_nothing_can_be_left_out(spark, rows):
    import numpy as np

    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 24)))], "id long, vector array<double>")
    index, pivots = similar.pivot_index(df, 8)
    assert rows(similar.indexed_neighbours(index, pivots, [0, 3, 200], 7)) == rows(similar.similar_entities(df, [0, 3, 200], 7))


def test_document_vectors_count_in_hash_tables(spark, capsys):
    """Keywords travel as bits: with strings Spark would sort every word. More than 62 take a second number."""
    words = [f"key{i:02d}." for i in range(70)]
    texts = spark.createDataFrame([(1, "KEY03. and key69. and key61."), (2, "none of them"), (3, None), (4, "key62. key00.")], "id long, text string")
    vectors = features.document_vectors(texts, words)
    vectors.explain()
    assert "SortAggregate" not in capsys.readouterr().out
    got = {r.id: (r.text.split(), sum(r.vector)) for r in vectors.collect()}
    assert got == {1: (["key03.", "key61.", "key69."], 5.0), 2: ([], 3.0), 4: (["key00.", "key62."], 2.0)}


def test_hybrid_documents_read_stored_vectors(spark, tmp_path, capsys):
    """Words are hashed once, not again for the count of documents and the vectors asked for."""
    rows = [(i, f"license of word{i} copy word{i % 3} the software") for i in range(1, 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    near = registry.queries()["similar_documents_hybrid"](spark, str(tmp_path))
    near.explain()
    assert "md5" not in capsys.readouterr().out
    assert near.count() == 21
