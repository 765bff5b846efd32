"""Null, date and ratio rules on literal rows."""

from datetime import date, datetime

from pyspark.sql import functions as F

from journeylake.functions import columns as c, labels


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first()["r"]


def test_truthy_spellings(spark):
    for text, want in [("Yes", True), (" y ", True), ("TRUE", True), ("1", True), ("no", False), ("", False), (None, False)]:
        assert one(spark, text, c.truthy("v")) is want


def test_lead_date_forms(spark):
    day = date(1996, 3, 5)
    for text, want in [("1996-03-05", day), ("05-03-1996", day), ("bad", None), (None, None), ("31-02-1996", None), ("", None)]:
        assert one(spark, text, c.lead_date("v")) == want


def test_lead_timestamp_forms(spark):
    for text, want in [
        ("1996-03-05 10:11:12", datetime(1996, 3, 5, 10, 11, 12)),
        ("05-03-1996 10:11", datetime(1996, 3, 5, 10, 11)),
        ("1996-03-05", datetime(1996, 3, 5)),
        ("noon", None),
    ]:
        assert one(spark, text, c.lead_timestamp("v")) == want


def test_rounded_int(spark):
    for text, want in [("12", 12), ("12.6", 13), ("n/a", None), (None, None)]:
        assert one(spark, text, c.rounded_int("v")) == want


def test_day_range_counts_the_whole_last_day(spark):
    late = datetime(2024, 1, 30, 23, 59, 59)
    assert one(spark, late, c.day_in("v", "2024-01-01", "2024-01-30"), "timestamp_ntz") is True
    assert one(spark, datetime(2024, 1, 31), c.day_in("v", "2024-01-01", "2024-01-30"), "timestamp_ntz") is False


def test_ratio_is_null_on_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 3), (None, 3)], "n int, d int")
    assert [r[0] for r in df.select(c.pct("n", "d", 2)).collect()] == [None, 33.33, None]


def test_blank_to_null(spark):
    assert one(spark, "   ", c.blank_to_null("v")) is None
    assert one(spark, " a ", c.blank_to_null("v")) == "a"


def test_segments_and_bands(spark):
    df = spark.createDataFrame(
        [(1, 0, 0, 0, 1), (0, 1, 0, 0, 1), (0, 0, 1, 0, 1), (0, 0, 0, 0, 1), (0, 0, 0, 0, 0)],
        "clicks int, opens int, bounces int, unsubscribes int, sends int")
    got = [r[0].split(" ")[0] for r in df.select(labels.engagement_segment()).collect()]
    assert got == ["High", "Mid", "At", "Low", "No"]
    ages = spark.createDataFrame([(17,), (18,), (26,), (36,), (46,), (56,), (66,), (None,)], "a int")
    assert [r[0] for r in ages.select(labels.age_group("a")).collect()] == [
        "Under 18", "18-25", "26-35", "36-45", "46-55", "56-65", "65+", "Unknown"]


def test_journey_code():
    assert labels.journey_short_code("J01 - Welcome") == "J01"
    assert labels.journey_short_code("All") is None
    assert labels.journey_short_code(None) is None


def test_values_are_data_not_sql(spark):
    df = spark.createDataFrame([("O'Hara",), ("%",)], "v string")
    assert df.filter(c.equals_folded("v", "o'hara")).count() == 1
    assert df.filter(c.contains_folded("v", "%")).count() == 1
    assert df.filter(F.col("v") == "x' or '1'='1").count() == 0


def test_only_whole_dates_count(spark):
    for text in ("2024", "2024-01", "2024-01-05 junk", "2024-01-05Tx", "2024-02-30", "32-01-2024", "13/45/2024", "15-Foo-2024", "15-anF-2024", "", "x", None):
        assert one(spark, text, c.lead_date("v")) is None, text
        assert one(spark, text, c.event_timestamp("v")) is None, text


def test_other_date_and_time_forms(spark):
    from datetime import date, datetime

    for text in ("01/15/2024", "1/15/2024", "15-Jan-2024", "15-JAN-2024", " 15-01-2024", "2024-01-15 ", "1/15/2024 10:00:00 AM", "2024-1-15T10:00"):
        assert one(spark, text, c.lead_date("v")) == date(2024, 1, 15), text
    for text, hour in (("1/15/2024 10:00:00 AM", 10), ("1/15/2024 10:00 PM", 22), ("1/15/2024 12:00:00 AM", 0), ("1/15/2024 12:00:00 PM", 12),
                       ("15-Jan-2024 9:00", 9), ("2024-01-15T09:00:00", 9), ("15-01-2024 09:00", 9)):
        assert one(spark, text, c.event_timestamp("v")) == datetime(2024, 1, 15, hour), text


def test_offsets_and_small_plans(spark):
    for text, want in [
        ("2024-01-05T10:00:00Z", datetime(2024, 1, 5, 10)), ("2024-01-05T10:00:00+00:00", datetime(2024, 1, 5, 10)),
        ("2024-01-05 23:30:00.5 -0500", datetime(2024, 1, 5, 23, 30, 0, 500000)), ("5-jan-2024 1:00 PM UTC", datetime(2024, 1, 5, 13)),
    ]:
        assert one(spark, text, c.lead_date("v")) == want.date(), text
        assert one(spark, text, c.event_timestamp("v")) == want, text
    assert one(spark, "2024-01-05 25:00", c.event_timestamp("v")) is None
    for made in (c.lead_date("v"), c.lead_timestamp("v")):
        plan = spark.createDataFrame([("x",)], "v string").select(made)._jdf.queryExecution().optimizedPlan().toString()
        assert len(plan) < 2000
