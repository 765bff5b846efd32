"""Tables in parts, batch-sized steps, sliced windows, late events."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from journeylake.operators import history
from journeylake.operators.keyed import unseen, with_slices
from journeylake.sources.lake import Lake, values_of
from journeylake.sources.layouts import LEAD_COLUMNS
from journeylake.streaming import file_streams, pipeline


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parts_reach_the_scan(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = spark.range(100).withColumn("day", F.when(F.col("id") > 0, F.expr("date_add(date'2024-01-01', cast(id % 10 as int))")))
    lake.append("t", "b1", lambda: rows, F.col("day"))
    lake.append("t", "b2", lambda: rows.withColumn("id", F.col("id") + 100), F.col("day"))
    again = Lake(spark, str(tmp_path))  # without the schema of what it has written
    for one in (lake, again):
        assert one.read("t").columns == ["id", "day"] and one.read("t").count() == 200 and one.read_batch("t", "b2").count() == 100
        part = one.read("t", ["2024-01-03", None])
        assert {r.day for r in part.collect()} == {date(2024, 1, 3), None}
        scan = [line for line in plan_of(part).split("\n") if "FileScan" in line][0]
        assert "PartitionFilters: [" in scan and "_part" in scan.split("PartitionFilters: ")[1]
        assert one.read("t", []).count() == 0


def test_a_small_batch_touches_its_buckets_only(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), buckets=32)
    people = spark.range(500).selectExpr("cast(id as string) as k", "0 as v")
    bucket = lake.bucket("k")
    lake.merge_parts("t", "b1", lambda: people, bucket)
    some = spark.createDataFrame([("3", 7), ("new", 8)], "k string, v int")
    touched = values_of(some, bucket)
    old = lake.read("t", touched)
    assert len(old.inputFiles()) <= len(touched) <= 2 and all(any(f"_part={p}/" in f for p in touched) for f in old.inputFiles())
    merged = old.join(some.select("k"), "k", "left_anti").unionByName(some)
    for _ in range(2):  # a retry repeats nothing
        lake.merge_parts("t", "b2", lambda: merged, bucket)
    written = [p.name for p in (tmp_path / "t" / "parts").glob("*b2/*") if p.is_dir()]
    assert sorted(written) == sorted(f"_part={p}" for p in touched)
    now = {r.k: r.v for r in Lake(spark, str(tmp_path), buckets=32).read("t").collect()}
    assert len(now) == 501 and now["3"] == 7 and now["new"] == 8 and now["4"] == 0
    # A part that no batch has is empty, and keeps the schema.
    assert lake.read("t", ["99"]).columns == ["k", "v"] and lake.read("t", ["99"]).count() == 0


def test_a_late_retry_is_not_put_on_top(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.replace("t", "b1", lambda: spark.range(1))
    lake.replace("t", "b2", lambda: spark.range(2))
    assert lake.replace("t", "b1", lambda: spark.range(1)) == 2 and lake.read("t").count() == 2


def lead(name, day, phone="1"):
    values = dict(zip(LEAD_COLUMNS, [name, "Lee", f"{name}@x.org", phone, "30", "Main St", None, "Salem", "or", "97301", "TRUE", "Web", f"{day} 10:00:00", day]))
    return (*values.values(), "p", "f", 1, datetime(2026, 1, 1))


def test_layers_read_and_write_what_a_batch_touches(spark, tmp_path):
    schema = ", ".join(f"{c} string" for c in LEAD_COLUMNS) + ", _source_path string, _source_file_name string, _source_row_number long, _loaded_at timestamp_ntz"
    lake = Lake(spark, str(tmp_path), buckets=16)
    pipeline.run_leads(lake, spark.createDataFrame([lead(f"P{i}", f"2026-01-{i % 28 + 1:02d}") for i in range(60)] + [lead("", "2026-01-05")], schema), "b1")
    second = spark.createDataFrame([lead("P7", "2026-02-01", "2"), lead("New", "2026-02-02"), lead("", "2026-01-05")], schema)
    pipeline.run_leads(lake, second, "b2")
    for name in ("silver/current", "gold/dim_prospect"):
        parts = [p for p in (tmp_path / name / "parts").glob("*-b2/_part=*")]
        assert 1 <= len(parts) <= 2, name
    assert [p.name for p in (tmp_path / "bronze/prospect_master/v00000001/_batch=b2").glob("_part=*")] == ["_part=2026-02-01"]
    current = {r.email: (r.version_num, r.phone_number) for r in lake.read("silver/current").collect()}
    assert len(current) == 61 and current["p7@x.org"] == (2, "2") and current["new@x.org"] == (1, "1")
    people = lake.read("gold/dim_prospect").collect()
    assert sorted(p.prospect_key for p in people) == list(range(1, 62)) and {p.email: p.intake_count for p in people}["p7@x.org"] == 2
    assert lake.read("audit/reject_log").count() == 1  # the same refused row twice
    before = {n: lake.read(n).count() for n in ("silver/history", "silver/current", "gold/fact_intake", "core/identity_xref")}
    pipeline.run_leads(lake, second, "b2")
    pipeline.run_leads(lake, second, "b3")  # the same rows as another delivery
    assert {n: lake.read(n).count() for n in before} == before


def test_the_existing_side_is_filtered_where_it_is_read(spark, tmp_path):
    spark.range(200_000).selectExpr("id", "id as payload").write.parquet(str(tmp_path / "old"))
    spark.createDataFrame([(5,), (300_000,), (None,)], "id long").write.parquet(str(tmp_path / "new"))
    old, new = spark.read.parquet(str(tmp_path / "old")), spark.read.parquet(str(tmp_path / "new"))
    fresh = unseen(new, old, ["id"], narrow=True)
    assert {r.id for r in fresh.collect()} == {300_000, None}
    # The scan of the old side feeds a semi join with the broadcast batch; only matches go on.
    lines = plan_of(fresh).split("\n")
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "old]" in line)
    join = max(i for i, line in enumerate(lines[:scan]) if "BroadcastHashJoin" in line and "LeftSemi" in line)
    assert not any("Exchange" in line for line in lines[join:scan])


def test_hot_month_is_cut_into_slices(spark):
    day = date(2026, 3, 1)
    hot = [("hot", day, datetime(2026, 3, 2, 0, i // 70, i // 7 % 10), f"r{i:04d}", i) for i in range(500)]
    rows = spark.createDataFrame(hot + [("cold", day, datetime(2026, 3, 2), "c", 1)], "k string, d date, t timestamp_ntz, r string, i int")
    sliced = with_slices(rows, ["k"], "d", ["t", "r"], 60, "b").cache()
    assert sliced.count() == 501 and sliced.groupBy("k", "b").count().agg(F.max("count")).first()[0] <= 60
    order = [r.i for r in sliced.filter("k = 'hot'").orderBy("b", "t", "r").collect()]
    assert order == list(range(500))


@pytest.mark.parametrize("many", [40])
def test_sliced_chain_equals_the_whole_one(spark, many):
    columns = [c for c in history.ROW_COLUMNS]
    def row(i, who):
        values = dict.fromkeys(columns)
        values |= {"record_id": f"{who}{i:04d}", "master_patient_id": who, "first_name": "A", "last_name": "B", "email": "a@x.org", "phone_number": str(i // 3),
                   "age": 30, "patient_consent": True, "channel": "Web", "submission_timestamp": datetime(2026, 1, 1), "file_date": date(2026, 3, 1 + i // 300),
                   "phi_loaded_at": datetime(2026, 3, 2), "is_active": True}
        return tuple(values[c] for c in columns)
    kinds = {"age": "int", "patient_consent": "boolean", "is_active": "boolean", "submission_timestamp": "timestamp_ntz", "phi_loaded_at": "timestamp_ntz", "file_date": "date"}
    data = spark.createDataFrame([row(i, "hot") for i in range(400)] + [row(0, "cold")], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in columns))
    none = history.empty_current(spark, data)
    key = lambda df: sorted(tuple(r) for r in df.select("record_id", "version_num", "eff_start_date", "eff_end_date", "is_current", "is_new").collect())
    assert key(history.scd2_versions(none, data, many)) == key(history.scd2_versions(none, data))


def test_late_events_are_kept(spark, tmp_path):
    lake, folder = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "ev")
    schema = "id long, ts timestamp_ntz"

    def deliver(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(folder)
        file_streams.load_events_once(
            lake, spark.readStream.schema(schema).parquet(folder), "ev", ["id"], "ts", "2 days", str(tmp_path / "cp")).awaitTermination()

    at = lambda day: datetime(2026, 1, day, 12)
    deliver((1, at(10)), (2, at(1)), (2, at(1)))
    deliver((3, at(5)), (4, at(9)), (1, at(10)), (5, None))
    deliver((3, at(5)), (6, at(11)))
    assert sorted(r.id for r in lake.read("ev").collect()) == [1, 2, 4, 5, 6]
    assert [r.id for r in lake.read("ev_late").collect()] == [3]


def test_a_silver_batch_is_shuffled_once(spark):
    schema = ("record_id string, master_patient_id string, first_name string, last_name string, email string, phone_number string, age int, "
              "address string, apartment_no string, city string, state string, zip_code string, patient_consent boolean, channel string, "
              "submission_timestamp timestamp_ntz, file_date date, phi_loaded_at timestamp_ntz, is_active boolean")

    def row(rid, pid, day, channel="a", dated=True):
        at = datetime(2026, 1, day)
        return (rid, pid, "f", "l", "e@x", "1", 30, "a", None, "c", "s", "z", True, channel, at, at.date() if dated else None, at, True)

    def exchanges(df):
        return plan_of(df).split("== Initial Plan ==")[-1].count("Exchange ")

    clean = spark.createDataFrame([row(f"r{p}{d}", f"P{p}", d + 1, "ab"[d // 2 % 2]) for p in range(4) for d in range(6)], schema)
    no_ids = spark.createDataFrame([], "record_id string")
    judged = history.silver_quality(clean, no_ids)
    assert exchanges(judged) == 0 and judged.filter("rejection_reason is null").count() == 24
    none = history.empty_current(spark, clean)
    assert exchanges(history.scd2_versions(none, clean)) == 1

    # Known, repeated and missing ids beside others; prospects with many rows or undated ones beside others.
    mixed = clean.unionByName(spark.createDataFrame(
        [row("r00", "P0", 1), row("r00", "P0", 1), row(None, "P9", 1), row(None, "P9", 2), row("u1", "P1", 9, "c", False),
         *(row(f"h{d}", "hot", d % 28 + 1, "abc"[d % 3]) for d in range(40))], schema))
    judged = history.silver_quality(mixed, spark.createDataFrame([("r35",), ("r35",), ("else",), (None,)], "record_id string"))
    assert sorted((r.record_id or "-", r.rejection_reason) for r in judged.filter("rejection_reason is not null").collect()) == [
        ("-", "DUPLICATE_RECORD_ID_IN_BRONZE"), *[("r00", "DUPLICATE_RECORD_ID_IN_BRONZE")] * 2, ("r35", "DUPLICATE_RECORD_ID")]
    assert judged.count() == 24 + 45
    good = judged.filter("rejection_reason is null").drop("rejection_reason")

    def versions(rows, most):
        return sorted(repr(tuple(r)) for r in history.scd2_versions(none, rows, most).collect())

    apart = [good.filter(F.col("master_patient_id") == p) for p in ("hot", "P0", "P1", "P2", "P3", "P9")]
    assert versions(good, 20) == versions(good, 1) == versions(good, 1000) == sorted(v for rows in apart for v in versions(rows, 1))


def test_months_without_rows_are_not_compared_and_bronze_keeps_the_layout(spark, tmp_path):
    schema = ", ".join(f"{c} string" for c in LEAD_COLUMNS) + ", _source_path string, _source_file_name string, _source_row_number long, _loaded_at timestamp_ntz"
    lake = Lake(spark, str(tmp_path), buckets=4)
    for batch, month in (("b1", 1), ("b2", 2), ("b3", 2)):
        pipeline.run_leads(lake, spark.createDataFrame(
            [lead(f"P{i}", f"2026-{month:02d}-{i + 1:02d}") for i in range(6 if batch == "b2" else 9)], schema), batch)
        rows = lake.read_batch("bronze/prospect_master", batch)
        assert rows.count() == {"b1": 9, "b2": 6, "b3": 3}[batch] and len(rows.inputFiles()) == 1
    assert lake.read_or_none("bronze/prospect_master", ["2026-03-01"]) is None
    assert lake.read_or_none("bronze/prospect_master", ["2026-01-01"]).count() == 9
    bronze = lake.read("bronze/prospect_master")
    assert bronze.columns[0] == "record_id" and bronze.filter(
        "record_id = md5(concat_ws('|', master_patient_id, cast(file_date as string)))").count() == 18
