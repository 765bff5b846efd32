"""Near-duplicate vectors by cross-polytope hashing with multiprobe, verified exactly.

In each of several tables a unit vector is rotated at random (three rounds of random signs
and a fast Hadamard transform) and hashed to its nearest signed axes: a bucket is the pair of
nearest axes of two rotations. A vector is stored under several probes per table, those pairs
of axes it is closest to. Vectors that share a bucket are compared by cosine in double
precision, in blocks; a pair is counted in the first bucket that it shares only.

Equal vectors form a class that stands for all its copies. A bucket larger than a block is
dealt over pairs of blocks, so no task holds a whole hot bucket, and pairs are never written
out: a task gives each vector's number of links, and links enough to connect what it linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import mixed, shuffle_width, written
from .graph import components

COSINE = 0.9
TABLES, PROBES, BLOCK = 10, 3, 1024
#: Vectors that one task call compares, in many buckets.
CALL_ROWS = 20_000
#: Signed axes of each of the two rotations that probes are made of.
AXES = 4


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row (a power of two wide), scaled to keep lengths."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """Each row rotated alike: three rounds of random signs and a Hadamard transform, in a
    space padded to a power of two."""
    wide = 1 << max(0, int(x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, wide - x.shape[1])))
    for r in range(3):
        bits = mixed(np.arange(wide, dtype=np.uint64) + np.uint64((seed * 3 + r) << 32))
        x = hadamard(x * np.where(bits & np.uint64(1), 1.0, -1.0))
    return x


def probes(x: np.ndarray, table: int, count: int = PROBES) -> np.ndarray:
    """The ``count`` nearest pairs of signed axes of each unit vector, as numbers; -1 where the
    space has fewer."""
    best, where = [], []
    for half in range(2):
        y = rotated(x, 2 * table + half)
        both = np.concatenate([y, -y], axis=1)
        k = min(AXES, both.shape[1])
        top = np.argsort(-both, axis=1, kind="stable")[:, :k]
        best.append(np.take_along_axis(both, top, axis=1))
        where.append(top)
    # The larger the sum of the two projections, the more likely a close vector hashes there.
    total = (best[0][:, :, None] + best[1][:, None, :]).reshape(len(x), -1)
    code = (where[0][:, :, None] * (1 << 20) + where[1][:, None, :]).reshape(len(x), -1).astype(np.int64)
    pick = np.argsort(-total, axis=1, kind="stable")[:, :count]
    out = np.full((len(x), count), -1, np.int64)
    out[:, : pick.shape[1]] = np.take_along_axis(code, pick, axis=1)
    return out


def directions(raw: list, kind: str) -> np.ndarray:
    """Unit vectors in double precision from their bytes, all of one length. Scaled by the
    largest component first, so that squares neither overflow nor vanish."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hashed(classes: DataFrame, kind: str, tables: int, count: int) -> DataFrame:
    """rep, copies, vector (bytes) and buckets, table by table. 32-bit numbers: two buckets that
    share one cost comparisons, no link."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [x.as_buffer() for x in batch["vector"]]
            size = np.array([len(x) for x in raw], np.int64)
            codes = np.zeros((len(raw), tables * count), np.int32)
            for w in np.unique(size):
                rows = np.flatnonzero(size == w)
                x = directions([raw[i] for i in rows], kind)
                for t in range(tables):
                    # Table and length are part of the bucket: only vectors of one length compare.
                    own = probes(x, t, count)
                    salt = mixed(np.array([t, w], np.uint64))
                    number = (mixed(own.astype(np.uint64) ^ salt[0] ^ (salt[1] >> np.uint64(1))) >> np.uint64(33)).astype(np.int32)
                    codes[rows, t * count : (t + 1) * count] = np.where(own < 0, number[:, :1], number)
            yield pa.RecordBatch.from_arrays(
                [batch["rep"], batch["copies"], batch["vector"],
                 pa.ListArray.from_arrays(pa.array(np.arange(len(raw) + 1, dtype=np.int32) * (tables * count)), pa.array(codes.ravel()))],
                ["rep", "copies", "vector", "buckets"])

    return classes.mapInArrow(step, "rep long, copies long, vector binary, buckets array<int>")


def _compare(kind: str, least: float):
    """Links inside pairs of blocks of buckets: (rep, links to other vectors, a linked rep)."""

    def step(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        column = {c: group[c].to_numpy() for c in ("bucket", "i", "j", "mine", "rep", "copies")}
        raw = [v.as_buffer() for v in group["vector"].chunk(0)]
        codes = group["buckets"].chunk(0)
        codes = codes.flatten().to_numpy().reshape(len(raw), -1)
        size = np.array([len(v) for v in raw])
        order = np.lexsort((column["j"], column["i"], column["bucket"], size))
        key = np.stack([size[order], column["bucket"][order], column["i"][order], column["j"][order]])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        out = []
        for rows in np.split(order, cuts):
            if len(rows) > 1:
                out.append(_block(directions([raw[r] for r in rows], kind), codes[rows], {c: v[rows] for c, v in column.items()}, least))
        rep, links, root = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        return pa.table({"rep": pa.array(rep, pa.int64()), "links": pa.array(links, pa.int64()), "root": pa.array(root, pa.int64())})

    return step


def _block(x: np.ndarray, codes: np.ndarray, column: dict, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rep, copies, mine = column["rep"], column["copies"], column["mine"]
    bucket, i, j = column["bucket"][0], column["i"][0], column["j"][0]
    left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
    links, parent = np.zeros(len(rep), np.int64), np.full(len(rep), -1, np.int64)
    for at in range(0, len(left), 256):
        rows = left[at : at + 256]
        a, b = np.nonzero(x[rows] @ x[right].T >= least)
        a, b = rows[a], right[b]
        ok = a != b if i != j else a < b
        a, b = a[ok], b[ok]
        for part in range(0, len(a), 1 << 14):
            p, q = a[part : part + (1 << 14)], b[part : part + (1 << 14)]
            # The first bucket that both have, in the order of the smaller rep's probes.
            low, high = np.where(rep[p] < rep[q], p, q), np.where(rep[p] < rep[q], q, p)
            todo, own = np.arange(len(p)), np.zeros(len(p), bool)
            for k in range(codes.shape[1]):
                code = codes[low[todo], k]
                hit = (codes[high[todo]] == code[:, None]).any(axis=1)
                own[todo[hit]] = code[hit] == bucket
                todo = todo[~hit]
                if not len(todo):
                    break
            p, q = p[own], q[own]
            np.add.at(links, p, copies[q])
            np.add.at(links, q, copies[p])
            _join(parent, p, q)
    linked = np.flatnonzero(links)
    return rep[linked], links[linked], rep[_roots(parent)[linked]]


def _roots(parent: np.ndarray) -> np.ndarray:
    root = np.where(parent >= 0, parent, np.arange(len(parent)))
    while True:
        further = root[root]
        if (further == root).all():
            return root
        root = further


def _join(parent: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Joins the trees of p[i] and q[i] for all i; parent is -1 at a root."""
    while len(p):
        root = _roots(parent)
        a, b = root[p], root[q]
        apart = a != b
        p, q, a, b = p[apart], q[apart], a[apart], b[apart]
        # Larger roots hang under smaller ones; where several want to, one wins and the rest follow.
        parent[np.maximum(a, b)] = np.minimum(a, b)


def near_vectors(vectors: DataFrame, least: float = COSINE, tables: int = TABLES, count: int = PROBES, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding).

    n_links is the number of other rows at a cosine of at least ``least`` that were found,
    component_id the smallest vec_id reachable by links, kept is vec_id = component_id. Null
    vectors, empty and zero ones and those with a null or non-finite component link with nothing.
    Vectors of different length don't link. Rows that repeat a vec_id count as rows; their
    component is found under that id. An empty table gives an empty table; further columns
    are ignored.
    """
    field = vectors.schema["embedding"].dataType
    single = isinstance(field, T.ArrayType) and isinstance(field.elementType, T.FloatType)
    kind = "<f4" if single else "<f8"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("v"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch["v"]:
                x = value.values
                x = x.to_numpy(zero_copy_only=False) if x is not None and len(x) and not x.null_count else np.zeros(1)
                # Negative zeros become zeros, so equal vectors have equal bytes.
                out.append((x + 0.0).astype(kind).tobytes() if np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(out, pa.binary())], ["vec_id", "vector"])

    rows = written(rows.mapInArrow(step, "vec_id long, vector binary"), "vectors")
    classes = written(rows.filter("vector is not null").groupBy("vector").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "vector-classes")
    placed = written(_hashed(classes, kind, tables, count), "vector-codes")
    each = placed.withColumn("bucket", F.explode(F.array_distinct("buckets")))
    sizes = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    dealt = each.join(sizes, "bucket").withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
    calls = max(shuffle_width(vectors.sparkSession), -(-classes.count() * tables * count // CALL_ROWS))
    dealt = dealt.withColumn("call", F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(calls))).drop("other", "blocks")
    found = written(dealt.groupBy("call").applyInArrow(_compare(kind, least), "rep long, links long, root long"), "vector-links")
    totals = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = written(components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))), "vector-components")
    known = classes.join(totals, "rep", "left").join(joined, F.col("rep") == F.col("node"), "left").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.join(known, "vector", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                      (component == F.col("vec_id")).alias("kept"))
