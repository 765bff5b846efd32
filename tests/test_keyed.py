"""Keys, merge and bucketed windows, against brute force where order matters."""

import random

import pytest
from pyspark.sql import Window, functions as F

from journeylake.operators import keyed


def test_merge_updates_inserts_and_keeps(spark, rows):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, name string, n int")
    source = spark.createDataFrame([(2, 99), (3, 30)], "k int, n int")
    assert rows(keyed.merge_rows(target, source, ["k"])) == [(1, "a", 10), (2, "b", 99), (3, None, 30)]
    assert rows(keyed.merge_rows(target, source, ["k"], update=())) == [(1, "a", 10), (2, "b", 20), (3, None, 30)]
    nulls = spark.createDataFrame([(2, None)], "k int, n int")
    assert (2, "b", 20) in rows(keyed.merge_rows(target, nulls, ["k"], prefer_filled=["n"]))
    assert (2, "b", None) in rows(keyed.merge_rows(target, nulls, ["k"]))


def test_merge_refuses_a_repeated_source_key(spark):
    target = spark.createDataFrame([(1, 10)], "k int, n int")
    source = spark.createDataFrame([(1, 1), (1, 2)], "k int, n int")
    with pytest.raises(Exception, match="not unique"):
        keyed.merge_rows(target, source, ["k"]).collect()


def test_dense_keys_follow_the_natural_order(spark):
    values = random.Random(3).sample(range(100000), 2000)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
    got = {r["v"]: r["n"] for r in keyed.assign_dense_keys(df, ["v"], 801, "n", partitions=6).collect()}
    assert got == {v: 801 + i for i, v in enumerate(sorted(values))}


def test_next_key(spark):
    df = spark.createDataFrame([(7,), (3,)], "k bigint")
    assert keyed.next_key(df, "k") == 8
    assert keyed.next_key(df.limit(0), "k", 801) == 801


def test_unseen_treats_null_keys_as_equal(spark, rows):
    new = spark.createDataFrame([("a", None), ("a", 1), (None, None)], "x string, y int")
    old = spark.createDataFrame([("a", None), (None, None)], "x string, y int")
    assert rows(keyed.unseen(new, old, ["x", "y"])) == [("a", 1)]


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = keyed.first_per_key(df, ["k"], [F.col("v").desc()], 2)
    assert sorted((r.k, r.v) for r in out.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_bucketed_windows_equal_plain_windows(spark):
    """One hot key with a third of the rows, many buckets, ties and gaps."""
    rnd = random.Random(11)
    data = [(0 if i % 3 == 0 else rnd.randrange(1, 40), rnd.randrange(0, 400), i, rnd.choice(["a", "b", None])) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, t int, i int, v string").withColumn("b", F.floor(F.col("t") / 30))
    w = Window.partitionBy("k").orderBy("t", "i")
    plain = df.withColumn("p", F.lag(F.struct("v")).over(w)).withColumn(
        "s", F.sum("t").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("n", F.lead("t").over(w))
    lagged = keyed.previous_value(df, ["k"], "b", ["t", "i"], F.col("v"), "p")
    both = keyed.total_and_next(lagged, ["k"], "b", ["t", "i"], F.col("t"), "t", "s", "n")

    def key(d):
        return sorted(((r.i, "first" if r.p is None else str(r.p.v), r.s, r.n) for r in d.collect()))

    assert key(plain) == key(both)


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 70000)], "k string, n int")
    counts = {r["k"]: r["count"] for r in keyed.repeat_rows(df, F.col("n")).groupBy("k").count().collect()}
    assert counts == {"b": 1, "c": 70000}
