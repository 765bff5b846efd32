"""Removal of byte strings that repeat, by suffix sorting with a difference cover.

A window is a string of ``length`` bytes; every byte that a window covers goes if that window
also starts anywhere else. Three steps find those windows without ever comparing all suffixes
of a corpus in one place:

1. Classes. The gram of a window with the smallest hash is its anchor. Equal windows have equal
   anchors at the same offset, so they fall into one class, the anchor's bytes. Runs of windows
   with one anchor are segments. Classes with one segment hold no repeat and go, exactly.
2. Suffix order. The segments of a class, equal ones only once, come to one task together.
   Those that agree with no other over half a window beside the anchor go, exactly. It
   sorts their suffixes by the difference-cover algorithm: name the triples at positions 1 and
   2 modulo 3 in sorted order, recurse on the names until they are unique or cover a whole
   window, sort the remaining suffixes by their first symbol and the rank behind it, merge.
   Neighbours in that order are compared over a whole window.
3. Removal. The windows found go back to every segment with those bytes; their spans are
   merged per document and cut out.

A class too large for one task (a very common passage in ever different surroundings) is
compared by 128-bit digests of windows and of content-defined runs of them, with partial sums
before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SLICE_BYTES, documents_of, mixed, shuffle_width, slices, text_bytes, written

LENGTH, GRAM = 200, 32
#: Stands for a missing doc_id.
NO_ID = -(1 << 63)
#: A larger class is counted by window digests; a task call sorts about CALL_BYTES.
CLASS_BYTES, CALL_BYTES, SORT_BYTES = 1 << 19, 4 << 20, 1 << 20
#: One window in so many ends a piece of a large class.
PIECE = 16

_VALUE32 = (mixed(np.arange(256, dtype=np.uint64) + np.uint64(5)) >> np.uint64(32)).astype(np.uint32)
_VALUE64 = mixed(np.arange(256, dtype=np.uint64) + np.uint64(905))
_BASE = 0xD1342543DE82EF95


# ---- suffix order -------------------------------------------------------------------------

def suffix_order(x: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``x`` (positive integers below 2^21) in the order of their suffixes. The
    order is exact over the first ``depth`` symbols; suffixes that agree so far stand together."""
    n = len(x)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: x[i:].tolist()), np.int64)
    x = np.concatenate([x.astype(np.int64), np.zeros(4, np.int64)])
    k = int(x.max()) + 1
    if k <= 1 << 9:
        # The symbols that occur, numbered in their order: few enough to name triples by a table.
        used = np.zeros(k, bool)
        used[x[:-4]] = True
        x[:-4] = np.cumsum(used)[x[:-4]]
        k = int(x.max()) + 1
    # The position n, an empty triple, keeps the two residues apart where the first ends on it.
    sample = np.concatenate([np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)])
    triple = (x[sample] * k + x[sample + 1]) * k + x[sample + 2]
    if k**3 <= 4 * n:
        used = np.zeros(k**3, bool)
        used[triple] = True
        name = np.cumsum(used)[triple]
        names = int(name.max())
    else:
        names, name = np.unique(triple, return_inverse=True)
        names, name = len(names), name.ravel() + 1
    if names < len(sample) and depth > 3:
        order = suffix_order(name, -(-depth // 3))
        ranked = np.empty(len(sample), np.int64)
        ranked[order] = np.arange(1, len(sample) + 1)
    else:
        ranked, order = name, np.argsort(name, kind="stable")
    rank = np.zeros(n + 4, np.int64)
    rank[sample] = ranked
    m = len(sample) + 2
    sampled = sample[order]
    sampled = sampled[sampled < n]
    rest = np.arange(0, n, 3)
    first = x[rest] * m + rank[rest + 1]
    rest = rest[np.argsort(first, kind="stable")]
    # A remaining suffix goes behind the sampled ones that are smaller, by either comparison.
    one, two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted(x[one] * m + rank[one + 1], x[rest] * m + rank[rest + 1])
    before += np.searchsorted((x[two] * k + x[two + 1]) * m + rank[two + 2], (x[rest] * k + x[rest + 1]) * m + rank[rest + 2])
    out = np.full(n, -1, np.int64)
    out[np.maximum.accumulate(before) + np.arange(len(rest))] = rest
    out[out < 0] = sampled
    return out


def repeated_starts(contents: list[bytes], starts: list[int], length: int) -> list[np.ndarray]:
    """For each content, which of its first ``starts`` windows also starts elsewhere."""
    data = np.frombuffer(b"\0".join(contents) + b"\0" * 8, np.uint8)
    size = np.array([len(c) + 1 for c in contents])
    begin = np.cumsum(size) - size
    symbols = data[:-8].astype(np.int64) + 1
    symbols[(begin + size - 1)[:-1]] = 257
    valid = np.zeros(len(symbols), bool)
    for b, s in zip(begin, starts):
        valid[b : b + s] = True
    order = suffix_order(symbols, length)
    order = order[valid[order]]
    p, q = order[:-1], order[1:]
    # The eight bytes from every position on as one number.
    eights = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,)).copy()
    for at in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        same = eights[p + at] == eights[q + at]
        p, q = p[same], q[same]
    found = np.zeros(len(symbols), bool)
    found[p] = found[q] = True
    return [found[b : b + s] for b, s in zip(begin, starts)]


# ---- classes ------------------------------------------------------------------------------

def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


#: Powers of the base and of its inverse that a worker keeps; longer texts make their own.
KEPT_POWERS = SLICE_BYTES + 1


@cache
def _kept_powers(base: int) -> np.ndarray:
    return _powers(base, KEPT_POWERS)


def _first_powers(base: int, n: int) -> np.ndarray:
    return _kept_powers(base)[:n] if n <= KEPT_POWERS else _powers(base, n)


class Bytes:
    """Hashes of any substring of ``data``, by differences of a running sum."""

    def __init__(self, data: np.ndarray):
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUE64[data] * _first_powers(_BASE, len(data)), out=self.total[1:])
        self.inverse = _first_powers(pow(_BASE, -1, 1 << 64), len(data) + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.total[end] - self.total[start]) * self.inverse[start] + mixed((end - start).astype(np.uint64)))


def anchors(data: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For every window the position of its gram with the smallest hash, the leftmost of equals."""
    h, span = _VALUE32[data], 1
    while span < gram:
        h = h[:-span] * np.uint32(2 * span * 0x9E3779B1 % (1 << 32) | 1) + h[span:]
        span *= 2
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    key = (h ^ (h >> np.uint32(16))).astype(np.uint64) << np.uint64(32) | np.arange(len(h), dtype=np.uint64)
    width, span = length - gram + 1, 1
    while 2 * span <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < width:
        key = np.minimum(key[: span - width], key[width - span :])
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, class, content) of every run of windows with one anchor."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 5
    at = anchors(data, length, gram)
    n = len(at)
    change = np.ones(n + 1, bool)
    change[1:n] = at[1:] != at[:-1]
    # Windows that reach into the next text don't count.
    beyond = offsets[1:] - length + 1
    edges = np.concatenate([offsets, beyond[beyond > offsets[:-1]]])
    change[edges[edges < n]] = True
    begin = np.flatnonzero(change)
    run, begin = np.diff(begin), begin[:-1]
    text = np.searchsorted(offsets, begin, "right") - 1
    own = begin + length <= offsets[text + 1]
    begin, run, text = begin[own], run[own], text[own]
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, gram)[at[begin]]).view(np.uint64)
    name = np.full(len(begin), gram, np.uint64)
    for w in words.T:
        name = mixed(name ^ w) * np.uint64(_BASE)
    content = Bytes(data).hash(begin, begin + run + length - 1) ^ mixed((at[begin] - begin).astype(np.uint64))
    return text, begin - offsets[text], run, mixed(name).view(np.int64), content.view(np.int64)


def _with_number(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and offsets of a batch, and a hash of each text, which tells apart rows with one doc_id."""
    data, offsets = text_bytes(batch["text"])
    number = np.zeros(batch.num_rows, np.int64)
    for i, j in slices(offsets):
        o = offsets[i : j + 1] - offsets[i]
        number[i:j] = Bytes(data[offsets[i] : offsets[j]]).hash(o[:-1], o[1:]).view(np.int64)
    return data, offsets, number


def _segment_rows(docs: DataFrame, length: int, gram: int, names_only: bool) -> DataFrame:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Names alone belong to no text.
            data, offsets, number = (*text_bytes(batch["text"]), None) if names_only else _with_number(batch)
            doc_id = batch["doc_id"].to_numpy()
            for i, j in slices(offsets):
                part = segments(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], length, gram)
                text, start, run, name, content = part
                if names_only:
                    name, seen = np.unique(name, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(seen)], ["name", "seen"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(name), pa.array(content), pa.array(doc_id[i + text]), pa.array(number[i + text]),
                         pa.array(start.astype(np.int32)), pa.array(run.astype(np.int32))],
                        ["name", "content", "doc_id", "number", "start", "run"])

    kinds = "name long, seen long" if names_only else "name long, content long, doc_id long, number long, start int, run int"
    return documents_of(docs).mapInArrow(step, kinds)


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, number and the zstandard-compressed text, small on its way through a shuffle."""
    import zstandard

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            number = _with_number(batch)[2]
            small = [press.compress(x.as_buffer()) for x in batch["text"].cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(number), pa.array(small, pa.binary())], ["doc_id", "number", "packed"])

    return documents_of(docs).mapInArrow(step, "doc_id long, number long, packed binary")


_RANGES = "array<struct<s:int,e:int>>"
_FOUND = f"name long, content long, run int, ranges {_RANGES}"


def _edges(found: np.ndarray) -> np.ndarray:
    """Where runs of found windows begin and end, in turn."""
    return np.flatnonzero(np.diff(np.concatenate([[0], found.view(np.int8), [0]]))).astype(np.int32)


def _found_table(name: list, content: list, run: list, edges: list) -> pa.Table:
    flat = np.concatenate([np.zeros(0, np.int32), *edges])
    pairs = pa.StructArray.from_arrays([pa.array(flat[::2]), pa.array(flat[1::2])], ["s", "e"])
    offsets = np.cumsum([0] + [len(e) // 2 for e in edges]).astype(np.int32)
    return pa.table({"name": pa.array(name, pa.int64()), "content": pa.array(content, pa.int64()),
                     "run": pa.array(run, pa.int32()), "ranges": pa.ListArray.from_arrays(pa.array(offsets), pairs)})


def _shared_sides(name: np.ndarray, contents: list[bytes], length: int, gram: int) -> np.ndarray:
    """Which segments may share a window with another one of their class.

    Equal windows hold the anchor at one offset, so at least half of their other bytes lie on one
    side of it, next to it: two segments that share a window agree there. Hashes only keep
    too many."""
    half = (length - gram + 1) // 2
    size = np.array([len(c) for c in contents])
    end = np.cumsum(size)
    begin = end - size
    data = np.frombuffer(b"".join(contents), np.uint8)
    anchor, hashes = anchors(data, length, gram)[begin], Bytes(data)
    keep = np.zeros(len(contents), bool)
    for start in (anchor - half, anchor + gram):
        own = np.flatnonzero((start >= begin) & (start + half <= end))
        side = hashes.hash(start[own], start[own] + half) ^ mixed(name[own].view(np.uint64))
        _, at, seen = np.unique(side, return_inverse=True, return_counts=True)
        keep[own] |= seen[at.ravel()] > 1
    return keep


def _sort_call(length: int, gram: int):
    """Sorts the suffixes of whole classes, several at a time, and compares neighbours."""

    def step(group: pa.Table) -> pa.Table:
        group = group.sort_by("name").combine_chunks()
        keep = _shared_sides(group["name"].to_numpy(), [x.as_py() for x in group["bytes"]], length, gram)
        group = group.filter(pa.array(keep)).combine_chunks()
        name, content, run = (group[c].to_numpy() for c in ("name", "content", "run"))
        raw = [x.as_py() for x in group["bytes"]]
        size = np.cumsum([len(x) + 1 for x in raw])
        last = np.flatnonzero(np.append(name[1:] != name[:-1], True)) + 1
        out, begin = [], 0
        while begin < len(name):
            base = size[begin - 1] if begin else 0
            ends = last[last > begin]
            end = int(ends[max(0, int(np.searchsorted(size[ends - 1], base + SORT_BYTES, "right")) - 1)])
            for i, hit in zip(range(begin, end), repeated_starts(raw[begin:end], run[begin:end].tolist(), length)):
                if hit.any():
                    out.append((name[i], content[i], run[i], _edges(hit)))
            begin = end
        return _found_table(*zip(*out)) if out else _found_table([], [], [], [])

    return step


def _pieces(text: bytes, rows: list[dict], length: int) -> pa.RecordBatch:
    """Runs of windows, cut after every window whose digest says so: equal runs of windows are
    cut alike. A piece has the digests of its windows and one over them all."""
    import xxhash

    out = []
    for r in rows:
        marks = [xxhash.xxh3_128_digest(text[r["start"] + k : r["start"] + k + length]) for k in range(r["run"])]
        ends = [k + 1 for k, m in enumerate(marks) if m[0] % PIECE == 0 or k + 1 == len(marks)]
        for k, end in zip([0, *ends[:-1]], ends):
            joined = b"".join(marks[k:end])
            out.append((r["name"], r["content"], r["run"], k, r["copies"], xxhash.xxh3_128_digest(joined), joined))
    kinds = pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["name", "content", "run", "k", "copies", "piece", "marks"])


def _by_digest(pieces: DataFrame) -> DataFrame:
    """Repeated windows of large classes. Pieces that occur twice go as a whole; a window of any
    other piece is looked for among the windows of all distinct pieces."""
    distinct = written(pieces.groupBy("piece").agg(F.sum("copies").alias("n"), F.first("marks").alias("marks")), "suffix-pieces")
    count = (F.length("marks") / 16).cast("int")
    window = F.explode(F.sequence(F.lit(0), count - 1)).alias("i")
    digest = F.substring("marks", F.col("i") * 16 + 1, F.lit(16)).alias("digest")
    again = distinct.select("n", "marks", window).select("n", digest).groupBy("digest").agg(F.sum("n").alias("n")).filter("n > 1").select("digest")
    whole = pieces.join(distinct.filter("n > 1").select("piece"), "piece").select("name", "content", "run", F.col("k").alias("s"), (F.col("k") + count).alias("e"))
    alone = pieces.join(distinct.filter("n = 1").select("piece"), "piece").select("name", "content", "run", "k", "marks", window)
    alone = alone.select("name", "content", "run", (F.col("k") + F.col("i")).alias("s"), (F.col("k") + F.col("i") + 1).alias("e"), digest)
    hit = whole.union(alone.join(again, "digest").drop("digest"))
    return hit.groupBy("name", "content", "run").agg(F.collect_list(F.struct("s", "e")).cast(_RANGES).alias("ranges"))


def _contents(wanted: DataFrame, docs: DataFrame, length: int, digests: bool) -> DataFrame:
    """The bytes of the ``wanted`` segments, or digests of their windows in pieces."""
    import zstandard

    lists = wanted.groupBy("doc_id", "number").agg(F.collect_list(F.struct("name", "content", "start", "run", "copies")).alias("wanted"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            for packed, wanted in zip(batch["packed"], batch["wanted"]):
                text, rows = open_.decompress(packed.as_buffer()), wanted.as_py()
                if digests:
                    yield _pieces(text, rows, length)
                else:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["name"] for r in rows], pa.int64()), pa.array([r["content"] for r in rows], pa.int64()),
                         pa.array([r["run"] for r in rows], pa.int32()),
                         pa.array([text[r["start"] : r["start"] + r["run"] + length - 1] for r in rows], pa.binary())],
                        ["name", "content", "run", "bytes"])

    kinds = "name long, content long, run int, " + ("k int, copies long, piece binary, marks binary" if digests else "bytes binary")
    # Rows equal in doc_id and text bring the same segments twice; the callers don't mind.
    return _packed(docs).join(lists, ["doc_id", "number"]).mapInArrow(step, kinds)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, class_bytes: int = CLASS_BYTES) -> DataFrame:
    """doc_id, n_bytes, spans (removed, from and to in bytes) and kept (the bytes left) of every row.

    ``gram`` is a power of two up to ``length``. Null texts count as empty; texts shorter than
    ``length`` lose nothing. Equal rows are rows of their own, so both lose what they share,
    also when they share a doc_id. Rows without doc_id take part like others (the smallest 64-bit
    number stands for a missing one). An empty table gives an empty table; further columns are
    ignored.
    """
    if length < 8 or gram < 8 or gram & (gram - 1) or gram > length:
        raise ValueError("gram must be a power of two from 8 up to length")
    spark = docs.sparkSession
    docs = docs.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    # Written, so that the join with it isn't in one stage with the aggregate: a very frequent name's rows can be split there.
    often = _segment_rows(docs, length, gram, True).groupBy("name").agg(F.sum("seen").alias("seen")).filter("seen > 1").select("name")
    often = written(often, "suffix-names")
    rows = written(_segment_rows(docs, length, gram, False).join(often, "name"), "suffix-segments")

    place = F.struct("doc_id", "number", "start")
    kinds = written(rows.groupBy("name", "content", "run").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("at")), "suffix-kinds")
    classes = written(kinds.groupBy("name").agg(F.count(F.lit(1)).alias("kinds"), F.sum(F.col("run") + length).alias("bytes")).filter("kinds > 1"),
                      "suffix-classes")
    met = kinds.join(classes, "name").select("name", "content", "run", "copies", "at.*", "bytes")
    total = classes.filter(F.col("bytes") <= class_bytes).agg(F.sum("bytes")).first()[0] or 0
    calls = max(shuffle_width(spark), -(-total // CALL_BYTES))
    found = (_contents(met.filter(F.col("bytes") <= class_bytes), docs, length, False)
             .withColumn("call", F.pmod(F.xxhash64("name"), F.lit(calls))).groupBy("call").applyInArrow(_sort_call(length, gram), _FOUND))
    found = written(found, "suffix-found")
    if not classes.filter(F.col("bytes") > class_bytes).isEmpty():
        pieces = _contents(met.filter(F.col("bytes") > class_bytes), docs, length, True).distinct()
        found = found.union(_by_digest(written(pieces, "suffix-hot")))
    # Segments with a copy go as a whole; of the others, the windows found.
    whole = kinds.filter("copies > 1").select("name", "content", "run", F.array(F.struct(F.lit(0).alias("s"), F.col("run").alias("e"))).cast(_RANGES).alias("ranges"))
    single = found.join(kinds.filter("copies = 1").select("name", "content", "run"), ["name", "content", "run"], "left_semi")
    spans = rows.join(whole.union(single), ["name", "content", "run"]).select("doc_id", "number", "start", F.explode("ranges").alias("r"))
    spans = spans.select("doc_id", "number", (F.col("start") + F.col("r.s")).alias("s"), (F.col("start") + F.col("r.e") + (length - 1)).alias("e")).distinct()
    lists = spans.groupBy("doc_id", "number").agg(F.collect_list(F.struct("s", "e")).alias("spans"))

    import zstandard

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
        for batch in batches:
            n_bytes, merged, kept = [], [], []
            for packed, spans in zip(batch["packed"], batch["spans"]):
                text, out, rest, at = open_.decompress(packed.as_buffer()), [], [], 0
                for s, e in sorted((x["s"], x["e"]) for x in spans.as_py() or []):
                    if out and s <= out[-1]["e"]:
                        out[-1]["e"] = max(e, out[-1]["e"])
                    else:
                        out.append({"s": s, "e": e})
                for x in out:
                    rest.append(text[at : x["s"]])
                    at = x["e"]
                n_bytes.append(len(text))
                merged.append(out)
                kept.append(b"".join([*rest, text[at:]]))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n_bytes, pa.int64()), pa.array(merged, kind), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"])

    done = _packed(docs).join(lists, ["doc_id", "number"], "left").select("doc_id", "packed", "spans").mapInArrow(
        step, f"doc_id long, n_bytes long, spans {_RANGES}, kept binary")
    return done.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))
