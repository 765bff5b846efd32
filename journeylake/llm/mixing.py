"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

The mean repetition rate of a source is its target share of the mixture over its share of the
corpus. Every document draws its number of copies from a Poisson distribution with that mean,
by inverting the distribution at a uniform number that a hash of seed, document and text
gives: a task that runs again draws the same numbers. Copies are then dealt over the cluster
in the order of another hash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .common import written

#: Means above this are drawn as a sum of independent equal parts, so exp(-mean) stays exact.
PART_MEAN = 16.0
#: Steps of one distribution table: the tail beyond is below 1e-16 for a mean of PART_MEAN.
STEPS = 80
#: Up to so many sources (about 700 bytes each) the rates are broadcast; more are joined by shuffle.
BROADCAST_SOURCES = 10_000


def _uniform(*parts: Column) -> Column:
    """A double in [0, 1) from the first 13 hexadecimal digits of an MD5."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, epochs: float = 1.0) -> DataFrame:
    """source, rows, rate, parts and the cumulated Poisson table of one part.

    ``weights`` are relative target shares by source (null: the source named ''); sources
    that it leaves out get weight 0. Without it all sources get the same share. ``epochs``
    is the size of the mixture over the size of the corpus, in rows.
    """
    counts = docs.groupBy(F.coalesce("source", F.lit("")).alias("mix_source")).agg(F.count(F.lit(1)).alias("rows"))
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("mix_source") == name, F.lit(float(value))).otherwise(weight)
    counts = counts.withColumn("weight", weight)
    # One row; the sources themselves stay a table, however many there are.
    totals = counts.agg(F.sum("rows").alias("r"), F.sum("weight").alias("w"))
    share = F.when(totals.select("w").scalar() > 0, F.col("weight") / totals.select("w").scalar()).otherwise(0.0)
    rate = share * F.lit(float(epochs)) * totals.select("r").scalar() / F.col("rows")
    parts = F.greatest(F.lit(1), F.ceil(rate / PART_MEAN).cast("int"))
    table = counts.withColumn("rate", rate).withColumn("parts", parts).withColumn("part_mean", F.col("rate") / F.col("parts"))
    start = F.struct(F.exp(-F.col("part_mean")).alias("p"), F.exp(-F.col("part_mean")).alias("c"),
                     F.array(F.exp(-F.col("part_mean"))).alias("all"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * F.col("part_mean") / k
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"), F.concat(s["all"], F.array(s["c"] + p)).alias("all"))

    cumulated = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)["all"]
    return table.select("mix_source", "rows", "rate", "parts", cumulated.alias("cdf"))


def mix_sources(
    docs: DataFrame, weights: Mapping[str, float] | None = None, epochs: float = 1.0, seed: str = "mix"
) -> DataFrame:
    """The mixture: all columns of ``docs``, copy_no (1..n), mix_rate and mix_order. Rows are
    dealt by mix_order, a hash, and sorted by it (ties by doc_id and copy_no), so that every
    partition holds a random slice in random order.

    A null source is the source ''. A null text draws like an empty one. Rows that are equal in
    doc_id and text draw the same number of copies. A source whose weight is 0 goes. An empty
    table gives an empty mixture. Columns named like the added ones are replaced.
    """
    docs = docs.drop("copy_no", "mix_rate", "mix_order")
    rates = written(source_rates(docs, weights, epochs), "mix-rates")
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    # One column holds the row, so that no name of it meets those added here.
    joined = docs.select(F.struct(*docs.columns).alias("row")).withColumn("mix_source", F.coalesce("row.source", F.lit(""))).join(
        rates.select("mix_source", F.col("rate").alias("mix_rate"), "parts", "cdf"), "mix_source")
    doc_id = F.col("row.doc_id")
    part = lambda i: F.size(F.filter(F.col("cdf"), lambda c: c <= _uniform(F.lit(seed), doc_id, i)))
    copies = F.aggregate(F.transform(F.sequence(F.lit(1), F.col("parts")), part), F.lit(0), lambda s, x: s + x)
    drawn = joined.withColumn("copies", copies).filter("copies > 0")
    each = drawn.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    order = F.md5(F.concat_ws("|", F.lit(seed + ".order"), doc_id.cast("string"), F.col("copy_no").cast("string")).cast("binary"))
    out = each.select("row", "copy_no", "mix_rate", order.alias("mix_order"))
    return out.repartition("mix_order").sortWithinPartitions("mix_order", doc_id, "copy_no").select("row.*", "copy_no", "mix_rate", "mix_order")
