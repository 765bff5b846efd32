"""Key-based building blocks that keep working when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import all_of
from ..session import cut_lineage


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of every key in ``order``.

    Written as ``row_number() <= k`` so that Spark limits each group inside every
    map task before the shuffle: a hot key sends k rows per task, not all its rows.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def unseen(new: DataFrame, existing: DataFrame, keys: Sequence[str], narrow: bool = False) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing``; null keys compare as equal.

    ``narrow`` first keeps the existing keys that ``new`` has, by a semi join whose small side is
    the batch: the large table is then filtered where it is read and not shuffled."""
    seen = existing.select(*[F.col(k).alias(f"_seen_{k}") for k in keys])
    if narrow:
        asked = new.select(*[F.col(k).alias(f"_asked_{k}") for k in keys])
        seen = seen.join(asked, all_of([F.col(f"_seen_{k}").eqNullSafe(F.col(f"_asked_{k}")) for k in keys]), "left_semi")
    match = all_of([new[k].eqNullSafe(F.col(f"_seen_{k}")) for k in keys])
    return new.join(seen, match, "left_anti")


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    prefer_filled: Sequence[str] = (),
) -> DataFrame:
    """Upsert as a full outer join; returns the whole new target.

    Matched rows take the columns in ``update`` from the source (default: every source
    column that is not a key; pass ``()`` for insert-only). Columns in ``prefer_filled``
    keep the target value where the source is null. Unmatched source rows are inserted;
    target columns the source lacks become null. A repeated source key fails the job
    instead of updating one row twice.
    """
    update = [c for c in source.columns if c not in keys] if update is None else list(update)
    checked = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_copies"),
        *[F.any_value(c).alias(f"_src_{c}") for c in source.columns if c not in keys],
    )
    src = checked.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[F.col(f"_src_{c}") for c in source.columns if c not in keys],
        F.when(F.col("_copies") > 1, F.raise_error(F.lit("merge source key is not unique")).cast("boolean"))
        .otherwise(F.lit(True)).alias("_in_source"),
    )
    tgt = target.withColumn("_in_target", F.lit(True))
    joined = tgt.join(src, all_of([tgt[k] == F.col(f"_key_{k}") for k in keys]), "full_outer")
    # Reading the flag here is what makes the uniqueness check run.
    matched = F.coalesce(F.col("_in_source"), F.lit(False))
    existed = F.coalesce(F.col("_in_target"), F.lit(False))

    def value(name: str) -> Column:
        if name in keys:
            return F.when(existed, F.col(name)).otherwise(F.col(f"_key_{name}"))
        if name not in source.columns:
            return F.col(name)
        incoming = F.col(f"_src_{name}")
        if name in prefer_filled:
            incoming = F.coalesce(incoming, F.col(name))
        take = matched if name in update else (matched & ~existed)
        return F.when(take, incoming).otherwise(F.col(name))

    return joined.select(*[value(c).alias(c) for c in target.columns])


def _indexed(df: DataFrame, order: Sequence[str], first: int, key: str, partitions: int | None = None) -> DataFrame:
    """Consecutive numbers from ``first`` in the order of columns, materialised once.

    One range-partitioned sort gives every row its place inside its partition; adding the
    row count of the partitions before it makes the number. Only those counts (one row per
    partition) are broadcast, and no window ever covers the rows. The sorted rows are
    materialised once, because counts and rows must come from the same partitioning.
    """
    # Without a number, the session's own size settings decide how many ranges there are.
    spread = (partitions, *order) if partitions else order
    # The id holds the partition in its upper bits and the place in the lower 33.
    placed = cut_lineage(
        df.repartitionByRange(*spread).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    ).withColumn("_slice", F.shiftright("_place", 33))
    counts = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(F.broadcast(offsets), "_slice")
        .withColumn(key, (F.lit(first) + F.col("_offset") + within).cast("bigint"))
        .drop("_slice", "_place", "_offset")
    )


def assign_dense_keys(
    df: DataFrame, order: Sequence[str], first: int, key: str, partitions: int | None = None
) -> DataFrame:
    """Consecutive numbers from ``first`` in the order of a unique natural key."""
    return _indexed(df, order, first, key, partitions)


def with_slices(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], most: int, out: str) -> DataFrame:
    """Adds ``out``, a struct of the bucket and a slice, such that no (key, ``out``) has more than
    ``most`` rows. It sorts like the bucket and ``order``, so it can take the bucket's place in
    `previous_value` and `total_and_next`.

    Only rows of larger groups are ranked, by one sort over range partitions; all others are
    slice 0 of their bucket. Keys and bucket must not be null."""
    group = [*keys, bucket]
    crowded = cut_lineage(df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most).select(*group))
    slice_of = lambda n: F.struct(F.col(bucket).alias("bucket"), n.cast("bigint").alias("slice"))
    if crowded.isEmpty():
        return df.withColumn(out, slice_of(F.lit(0)))
    ranked = _indexed(df.join(crowded, group, "left_semi"), [*group, *order], 0, "_index")
    firsts = ranked.groupBy(*group).agg(F.min("_index").alias("_first"))
    hot = ranked.join(cut_lineage(firsts), group)
    hot = hot.withColumn(out, slice_of(F.floor((F.col("_index") - F.col("_first")) / most))).drop("_index", "_first")
    return df.join(crowded, group, "left_anti").withColumn(out, slice_of(F.lit(0))).unionByName(hot)


def next_key(existing: DataFrame, key: str, first: int = 1) -> int:
    """One past the largest assigned key, or ``first`` for an empty table."""
    row = existing.agg(F.max(key).alias("m")).first()
    return first if row["m"] is None else int(row["m"]) + 1


def previous_value(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], value: Column, out: str
) -> DataFrame:
    """``lag(value)`` per key without putting a whole key into one window group.

    Rows are windowed inside (key, bucket); the first row of each bucket takes the last
    value of the nearest earlier bucket from a table with one row per (key, bucket).
    ``bucket`` must be non-null and must sort like the leading order column.
    """
    boxed = F.struct(value.alias("v"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(bucket)
    tails = (
        df.groupBy(*keys, bucket)
        .agg(F.max_by(boxed, F.struct(*order)).alias("_tail"))
        .select(*keys, bucket, F.lag("_tail").over(across).alias("_carry"))
    )
    return (
        df.withColumn("_prev", F.lag(boxed).over(inside))
        .join(tails, [*keys, bucket])
        .withColumn(out, F.coalesce("_prev", "_carry"))
        .drop("_prev", "_carry")
    )


def total_and_next(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], weight: Column, value: str,
    total: str, following: str,
) -> DataFrame:
    """Running total of ``weight`` and ``lead(value)`` per key, bucketed like `previous_value`."""
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(bucket)
    heads = (
        df.groupBy(*keys, bucket)
        .agg(F.sum(weight).alias("_sum"), F.min_by(value, F.struct(*order)).alias("_head"))
        .select(
            *keys,
            bucket,
            F.coalesce(
                F.sum("_sum").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_before"),
            F.lead("_head").over(across).alias("_next_head"),
        )
    )
    running = F.sum(weight).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        df.withColumn("_running", running)
        .withColumn("_next", F.lead(value).over(inside))
        .join(heads, [*keys, bucket])
        .withColumn(total, F.col("_running") + F.col("_before"))
        .withColumn(following, F.coalesce("_next", "_next_head"))
        .drop("_running", "_next", "_before", "_next_head")
    )


def repeat_rows(df: DataFrame, copies: Column) -> DataFrame:
    """Each row ``copies`` times, through two nested sequences of at most 65536 numbers
    each, so that a very large count never becomes one very large array."""
    step = 65536
    return (
        df.withColumn("_copies", copies.cast("bigint"))
        .filter(F.col("_copies") > 0)
        .withColumn("_block", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / step).cast("bigint"))))
        .withColumn("_item", F.explode(F.sequence(
            F.lit(1).cast("bigint"),
            F.least(F.lit(step).cast("bigint"), F.col("_copies") - F.col("_block") * step))))
        .drop("_copies", "_block", "_item")
    )
