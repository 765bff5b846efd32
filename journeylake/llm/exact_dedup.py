"""Exact deduplication: static binary-fuse filters per snapshot, exact buckets, byte checks.

A snapshot is a written, immutable set of distinct text digests, dealt into buckets by their
leading bits; each bucket carries a binary-fuse filter of its digests. An incoming batch is
first grouped by digest within itself. Its distinct digests then meet the filters bucket by
bucket: what a filter refuses is new for certain, and only what it lets pass is joined with
the exact digests. Groups that more than one row belongs to are confirmed byte by byte.

Digests are spread evenly and distinct before anything is grouped by bucket, so no bucket is
hot; a text with very many copies is one row per task before any shuffle of groups.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import documents_of, mixed, written

#: Digests of a snapshot that share one filter.
BUCKET_KEYS = 100_000


# ---- binary-fuse filter -------------------------------------------------------------------

def _layout(n: int) -> tuple[int, int]:
    """Segment length (a power of two) and number of starting segments for three-wise fuse."""
    length = 4 if n < 2 else min(1 << 18, 1 << int(math.floor(math.log(n) / math.log(3.33) + 2.25)))
    factor = 1.125 if n < 2 else max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    return length, max(1, -(-int(round(n * factor)) // length) - 2)


def _places(keys: np.ndarray, seed: int, length: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Three slots in three consecutive segments, and the 16-bit fingerprint, of each key."""
    h = mixed(keys + np.uint64(seed))
    segment = ((h >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
    base = segment.astype(np.int64) * length
    mask = np.uint64(length - 1)
    slots = np.stack([base + (h & mask).astype(np.int64),
                      base + length + ((h >> np.uint64(18)) & mask).astype(np.int64),
                      base + 2 * length + (mixed(h) & mask).astype(np.int64)])
    return slots, (mixed(h ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(48)).astype(np.uint16)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """Seed, segment length, segment count and fingerprints of a static filter of distinct
    64-bit keys. Slots with a single key are peeled in rounds, then filled in reverse."""
    keys = np.unique(keys.astype(np.uint64))
    for attempt in range(64):
        length, count = _layout(len(keys))
        count += attempt * max(1, count // 16)
        seed = int(mixed(np.array([attempt + 1], np.uint64))[0])
        slots, prints = _places(keys, seed, length, count)
        size = (count + 2) * length
        degree = np.bincount(slots.ravel(), minlength=size)
        alive, rounds = np.arange(len(keys)), []
        while len(alive):
            free = degree[slots[:, alive]] == 1
            peel = free.any(axis=0)
            if not peel.any():
                break
            own = alive[peel]
            at = slots[free[:, peel].argmax(axis=0), own]
            rounds.append((own, at))
            np.subtract.at(degree, slots[:, own].ravel(), 1)
            alive = alive[~peel]
        if len(alive):
            continue
        table = np.zeros(size, np.uint16)
        for own, at in reversed(rounds):
            s = slots[:, own]
            table[at] = prints[own] ^ table[s[0]] ^ table[s[1]] ^ table[s[2]] ^ table[at]
        return seed, length, count, table
    raise RuntimeError("no filter could be built")


def in_filter(keys: np.ndarray, seed: int, length: int, count: int, table: np.ndarray) -> np.ndarray:
    """Never false for a key of the filter; true for others about once in 65,536."""
    slots, prints = _places(keys.astype(np.uint64), seed, length, count)
    return (table[slots[0]] ^ table[slots[1]] ^ table[slots[2]]) == prints


# ---- digests ------------------------------------------------------------------------------

def digests(docs: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """doc_id, SHA-256 of the text lower-cased in A-Z only, and its leading ``digest_bytes``."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lowered = pc.ascii_lower(batch["text"]).cast(pa.binary())
            full = [hashlib.sha256(x.as_buffer()).digest() for x in lowered]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(full, pa.binary()), pa.array([x[:digest_bytes] for x in full], pa.binary())],
                ["doc_id", "sha", "digest"])

    return documents_of(docs).mapInArrow(step, "doc_id long, sha binary, digest binary")


def _bucket(buckets: int) -> Column:
    """From the digest's leading bytes, which are spread evenly."""
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")


def _keys(values: pa.Array) -> np.ndarray:
    """64-bit filter keys from digests: their first eight bytes, mixed."""
    return mixed(np.frombuffer(b"".join(v.as_py()[:8].ljust(8, b"\0") for v in values), "<u8").copy())


# ---- snapshot and screening ---------------------------------------------------------------

def snapshot_filters(snapshot: DataFrame, buckets: int) -> DataFrame:
    """One filter row per bucket of a snapshot of distinct digests."""

    def build(table: pa.Table) -> pa.Table:
        seed, length, count, prints = build_filter(_keys(table["digest"].combine_chunks()))
        return pa.table({"bucket": table["bucket"][:1], "seed": pa.array([seed], pa.decimal128(20)),
                         "length": pa.array([length], pa.int64()), "segments": pa.array([count], pa.int64()),
                         "prints": pa.array([prints.tobytes()], pa.binary())})

    return (snapshot.select(_bucket(buckets).alias("bucket"), "digest").groupBy("bucket")
            .applyInArrow(build, "bucket int, seed decimal(20,0), length long, segments long, prints binary"))


def screen(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """Incoming digests that may be in the snapshot. A bucket the snapshot lacks refuses all."""

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return left.slice(0, 0)
        f = right.slice(0, 1).to_pylist()[0]
        hit = in_filter(_keys(left["digest"].combine_chunks()), int(f["seed"]), f["length"], f["segments"],
                        np.frombuffer(f["prints"], np.uint16))
        return left.filter(pa.array(hit))

    return (incoming.select(_bucket(buckets).alias("bucket"), "digest").groupBy("bucket")
            .cogroup(filters.groupBy("bucket")).applyInArrow(look, "bucket int, digest binary"))


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep"), F.count(F.lit(1)).alias("copies"))


def exact_dedup(docs: DataFrame, incoming: Column | None = None, digest_bytes: int = 32) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``docs``.

    ``incoming`` marks the rows of the new batch; the others form the snapshot (default:
    every second row by a hash of doc_id). The result doesn't depend on the split. Texts are
    equal when identical after lower-casing A-Z only; of equal texts the row with the largest
    doc_id stays. A null text counts as empty, so null and empty texts form one group. Repeated
    doc_ids are rows of their own and count as such; of rows that share the largest doc_id all
    are marked kept. A null doc_id is smaller than any other. An empty table gives an empty table; further columns are ignored.
    ``digest_bytes`` cuts the digest that rows are grouped by: shorter ones only make byte
    checks tell more texts apart.
    """
    fresh = incoming if incoming is not None else F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    rows = written(digests(docs, digest_bytes).withColumn("fresh", F.coalesce(fresh, F.lit(False))), "exact-digests")
    old = written(_groups(rows.filter(~F.col("fresh"))), "exact-snapshot")
    new = written(_groups(rows.filter("fresh")), "exact-incoming")
    # Both sides of a bucket stay small, whichever of them is the larger one.
    buckets = max(1, -(-max(old.count(), new.count()) // BUCKET_KEYS))
    filters = written(snapshot_filters(old, buckets), "exact-filters")
    positives = screen(new, filters, buckets).select("digest")
    shared = positives.join(old.select("digest"), "digest", "left_semi")
    several = written(
        old.filter("copies > 1").select("digest").union(new.filter("copies > 1").select("digest")).union(shared).distinct(),
        "exact-several")

    # Byte checks: only rows whose digest another row has bring their text along.
    suspects = rows.join(several, "digest", "left_semi").select("doc_id", "digest", "sha")
    # A repeated doc_id may stand for different texts; the digest sorts them out.
    ids = suspects.select("doc_id").distinct()
    every = documents_of(docs)
    texts = every.join(ids.withColumnRenamed("doc_id", "_id"), every["doc_id"].eqNullSafe(F.col("_id")), "left_semi")

    def normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lowered = pc.ascii_lower(batch["text"])
            full = [hashlib.sha256(x.as_buffer()).digest() for x in lowered.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([x[:digest_bytes] for x in full], pa.binary()), pa.array(full, pa.binary()), lowered],
                ["doc_id", "digest", "sha", "text"])

    classes = (texts.mapInArrow(normalised, "doc_id long, digest binary, sha binary, text string")
               .groupBy("digest", "sha", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    checked = written(classes.select("digest", "sha", "keep_id", "group_size"), "exact-classes")
    # Two texts with one full digest would both be here, told apart by their bytes.
    same = checked.groupBy("digest", "sha").agg(
        F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts"))
    same = same.withColumn("keep_id", F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share a SHA-256"))).otherwise(F.col("keep_id")))
    # Written, so that the rows of a hot text can be split in the join with it.
    out = rows.join(written(same.drop("texts"), "exact-same"), ["digest", "sha"], "left")
    keep = F.coalesce("keep_id", "doc_id")
    return out.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
