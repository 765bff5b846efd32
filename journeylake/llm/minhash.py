"""Near-duplicate documents by BagMinHash over word shingles.

A document is the multiset of its shingles of five words. BagMinHash draws, for every shingle,
Poisson processes over its weight, discretised in cells of one occurrence and arranged in
levels that double: [0,1), [1,2), [2,4), … A point has a time, a component of the signature
and a place in the level; it counts where the place lies below the weight. The signature keeps
the earliest point of each component, so two signatures agree in a component with the
probability of the weighted Jaccard similarity. Points are made in the order of time and only
up to a document's own limit, so a document costs one hash per shingle and a few hundred more.

Documents with equal multisets form a class, of which one stands for all. Signatures are cut
into bands; documents that share a band's bucket are candidates. Each meets the bucket's
smallest document first, and the multisets of each pair are compared in full. What is linked
forms components; in a second pass the members of a bucket that are still in different
components meet block by block, so a large group of near copies costs one pair per member, and
no link between components is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import column, documents_of, mixed, slices, text_bytes, unit, written
from .graph import components

WORDS, THRESHOLD = 5, 0.8
#: 24 bands of 4: a pair at 0.8 is missed by all bands about once in 300,000.
COMPONENTS, BAND = 96, 4
#: Pairs whose signatures agree in a smaller share aren't compared: 0.8 less six standard errors,
#: which costs a pair at 0.8 less than a tenth of what the bands miss.
SLACK = 6 * (THRESHOLD * (1 - THRESHOLD) / COMPONENTS) ** 0.5
BLOCK = 2048

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_VALUE = mixed(np.arange(1, 257, dtype=np.uint64))[_LOWER]
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP, _KEEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(32)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every word: a run of bytes other than ASCII white space, with A-Z lower-cased."""
    n = len(data)
    solid = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(solid & (np.concatenate([[True], ~solid[:-1]]) | cut[:-1])) if n else np.zeros(0, np.int64)
    ends = np.flatnonzero(solid & (np.concatenate([~solid[1:], [True]]) | cut[1:])) + 1 if n else starts
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * _powers(_BASE, n), out=total[1:])
    inverse = _powers(pow(_BASE, -1, 1 << 64), n)
    hashes = mixed((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _STEP)
    return hashes, np.searchsorted(offsets, starts, "right") - 1


def shingles_of(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, count), sorted. A document of fewer words is one shingle of them all."""
    word, doc = words_of(data, offsets)
    factors = mixed(np.arange(1000, 1000 + words, dtype=np.uint64))
    n = np.bincount(doc, minlength=len(offsets) - 1)
    at = np.flatnonzero(doc[: len(doc) - words + 1] == doc[words - 1 :]) if len(doc) >= words else np.zeros(0, np.int64)
    value = np.zeros(len(at), np.uint64)
    for j in range(words):
        value += word[at + j] * factors[j]
    first, short = np.concatenate([[0], np.cumsum(n)[:-1]]), np.flatnonzero((n > 0) & (n < words))
    few = n[short].astype(np.uint64) * _STEP
    for j in range(words - 1):
        there = n[short] > j
        few[there] += word[first[short[there]] + j] * factors[j]
    value, owner = mixed(np.concatenate([value, few])), np.concatenate([doc[at], short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    where = np.flatnonzero(fresh)
    return owner[where], value[where], np.diff(np.append(where, len(value)))


def signatures(owner: np.ndarray, shingle: np.ndarray, count: np.ndarray, docs: int, m: int = COMPONENTS) -> np.ndarray:
    """BagMinHash signatures (docs x m, 32 bits a component); rows of empty documents are zero."""
    out = np.zeros((docs, m), np.uint32)
    weight = np.bincount(owner, count, minlength=docs)
    # Levels that an element's weight reaches into: level r > 0 covers [2^(r-1), 2^r).
    levels = np.where(count > 1, np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64), 0) + 1
    element = np.repeat(np.arange(len(owner)), levels)
    level = np.arange(len(element)) - np.repeat(np.cumsum(levels) - levels, levels)
    width = np.where(level > 0, 2.0 ** (level - 1), 1.0)
    seed = mixed(shingle[element] ^ mixed(level.astype(np.uint64) + np.uint64(77)))
    doc, most = owner[element], count[element]
    todo, limit = weight > 0, m / np.maximum(weight, 1) * (np.log(m) + 3)
    while todo.any():
        live = np.flatnonzero(todo[doc])
        time, step, found = np.zeros(len(live)), 0, []
        while len(live):
            step += 1
            point = mixed(seed[live] + np.uint64(step * int(_STEP) % (1 << 64)))
            time = time - np.log(unit(point)) / width[live]
            soon = time <= limit[doc[live]]
            live, time, point = live[soon], time[soon], point[soon]
            more = mixed(point ^ _STEP)
            place = width[live] * ((level[live] > 0) + unit(mixed(more)))
            inside = np.floor(place) < most[live]
            slot = ((more >> _KEEP) * np.uint64(m)) >> _KEEP
            found.append((doc[live[inside]] * m + slot[inside].astype(np.int64), time[inside], (point[inside] >> _KEEP).astype(np.uint32)))
        slot, time, mark = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((mark, time, slot))
        slot, mark = slot[order], mark[order]
        first = np.ones(len(slot), bool)
        first[1:] = slot[1:] != slot[:-1]
        out.ravel()[slot[first]] = mark[first]
        filled = np.bincount(slot[first] // m, minlength=docs)
        # A component without a point so far: this document again, twice as far.
        todo &= filled < m
        limit[todo] *= 2
    return out


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (sorted shingles, counts)."""
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    same = a[0][at] == b[0] if len(a[0]) else np.zeros(len(b[0]), bool)
    common = np.minimum(a[1][at[same]], b[1][same]).sum()
    total = a[1].sum() + b[1].sum() - common
    return float(common / total) if total else 0.0


def signed(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n (shingles), a and b (a fingerprint of the multiset) and sig of every row."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            for i, j in slices(offsets):
                n = j - i
                owner, shingle, count = shingles_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
                sums = []
                for salt in (11, 12):
                    part = np.zeros(n, np.uint64)
                    np.add.at(part, owner, mixed(shingle ^ np.uint64(salt)) * count.astype(np.uint64))
                    sums.append(part.view(np.int64))
                sig = signatures(owner, shingle, count, n)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(i, n), column(np.bincount(owner, count, minlength=n).astype(np.int64), pa.int64()),
                     column(sums[0], pa.int64()), column(sums[1], pa.int64()), pa.array([r.tobytes() for r in sig], pa.binary())],
                    ["doc_id", "n", "a", "b", "sig"])

    return documents_of(docs).mapInArrow(step, "doc_id long, n long, a long, b long, sig binary")


def _bands(classes: DataFrame) -> DataFrame:
    wide = 4 * BAND
    keys = F.transform(F.sequence(F.lit(0), F.lit(COMPONENTS // BAND - 1)),
                       lambda i: F.xxhash64(F.substring("sig", i * wide + 1, F.lit(wide)), i))
    return classes.select(F.col("doc_id").alias("rep"), F.posexplode(keys).alias("band", "key"))


def packed_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id and zstandard-compressed text of the documents in ``ids``."""
    import zstandard

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            small = [press.compress(x.as_buffer()) for x in batch["text"].cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(small, pa.binary())], ["doc_id", "packed"])

    packed = documents_of(docs).mapInArrow(step, "doc_id long, packed binary")
    return packed.join(ids, "doc_id")


def verified(pairs: DataFrame, texts: DataFrame, words: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose multisets overlap enough. ``texts`` has doc_id, packed and n."""
    import zstandard

    def side(x: str) -> DataFrame:
        return texts.select(*[F.col(c).alias(x if c == "doc_id" else f"{c}_{x}") for c in ("doc_id", "packed", "n")])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, last, left = zstandard.ZstdDecompressor(), None, None

        def multiset(packed: pa.Scalar):
            data = np.frombuffer(open_.decompress(packed.as_buffer()), np.uint8)
            return shingles_of(data, np.array([0, len(data)]), words)[1:]

        for batch in batches:
            a, b = batch["a"].to_numpy(), batch["b"].to_numpy()
            good = np.zeros(len(a), bool)
            for i in range(len(a)):
                n, m = batch["n_a"][i].as_py(), batch["n_b"][i].as_py()
                if min(n, m) < threshold * max(n, m):
                    continue
                if a[i] != last:
                    last, left = a[i], multiset(batch["packed_a"][i])
                good[i] = jaccard(left, multiset(batch["packed_b"][i])) >= threshold
            yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good])], ["a", "b"])

    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(step, "a long, b long")


def overlaps(sets: list[tuple[np.ndarray, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarities of the pairs (a[i], b[i]) of multisets. Many pairs at once
    are products of 0/1 rows, one column for each occurrence of a shingle that several share."""
    owner = np.repeat(np.arange(len(sets)), [int(c.sum()) for _, c in sets])
    count = np.concatenate([c for _, c in sets])
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    value = np.repeat(np.concatenate([v for v, _ in sets]), count)
    value = mixed(value ^ (nth.astype(np.uint64) * _STEP))
    _, column, times = np.unique(value, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    # About 15 microseconds for a pair alone, 20 operations a nanosecond in a product.
    if len(a) * 15e-6 < 2.0 * len(sets) ** 2 * len(shared) / 20e9:
        return np.array([jaccard(sets[x], sets[y]) for x, y in zip(a.tolist(), b.tolist())])
    place = np.full(len(times), -1)
    place[shared] = np.arange(len(shared))
    column = place[column.ravel()]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, len(shared), 2048):
        own = (column >= at) & (column < at + 2048)
        rows = np.zeros((len(sets), min(2048, len(shared) - at)), np.float32)
        rows[owner[own], column[own] - at] = 1
        common += rows @ rows.T
    total = np.bincount(owner, minlength=len(sets))
    both = common[a, b].astype(np.float64)
    return both / (total[a] + total[b] - both)


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links connect what earlier ones have left apart."""
    parent, keep = {}, np.zeros(len(a), bool)

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        keep[i] = x != y
        parent[x] = y
    return keep


def _across(members: DataFrame, words: int, threshold: float) -> DataFrame:
    """Links (a, b) that connect members of one bucket in different components. A bucket larger
    than a block is dealt over pairs of blocks; a pair is compared in the first band it shares,
    if lengths and signatures allow, and only links that connect leave the task."""
    import zstandard

    sizes = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(sizes, "key").withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))

    def step(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        rep, comp, mine, n = (group[c].to_numpy() for c in ("rep", "comp", "mine", "n"))
        sig = np.frombuffer(b"".join(x.as_buffer() for x in group["sig"].chunk(0)), np.uint32).reshape(len(rep), -1)
        i, j, band = group["i"][0].as_py(), group["j"][0].as_py(), group["band"][0].as_py()
        found = []
        for x in np.flatnonzero(mine == i):
            ok = (comp != comp[x]) & ((mine == j) if i != j else (rep > rep[x]))
            ok &= np.minimum(n, n[x]) >= threshold * np.maximum(n, n[x])
            y = np.flatnonzero(ok)
            same = sig[y] == sig[x]
            # Not in an earlier band: that bucket has the pair too.
            earlier = same[:, : band * BAND].reshape(len(y), band, BAND).all(axis=2).any(axis=1)
            y = y[(same.mean(axis=1) >= threshold - SLACK) & ~earlier]
            found.append(np.stack([np.full(len(y), x), y]))
        a, b = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        if len(a):
            used, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            open_, packed = zstandard.ZstdDecompressor(), group["packed"].chunk(0)
            texts = [np.frombuffer(open_.decompress(packed[int(u)].as_buffer()), np.uint8) for u in used]
            sets = [shingles_of(t, np.array([0, len(t)]), words)[1:] for t in texts]
            good = overlaps(sets, at.ravel()[: len(a)], at.ravel()[len(a) :]) >= threshold - 1e-12
            a, b = a[good], b[good]
            keep = _forest(comp[a], comp[b])
            a, b = a[keep], b[keep]
        return pa.table({"a": pa.array(rep[a], pa.int64()), "b": pa.array(rep[b], pa.int64())})

    return dealt.groupBy("key", "i", "j").applyInArrow(step, "a long, b long").distinct()


def near_dedup(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, component_id, kept and n_shingles of every row.

    class_id is the smallest doc_id with the same multiset of shingles, component_id the
    smallest doc_id reachable by links (weighted Jaccard of at least ``threshold``), kept is
    doc_id = component_id. Words are runs of characters other than ASCII white space, A-Z
    lower-cased; a text of fewer than ``words`` words is one shingle of them all. Null, empty
    and blank texts have no shingle and link with nothing. Rows with one doc_id are kept or go
    together, and their texts are compared under that id. A row without doc_id is kept unless a row
    with one has its multiset; near copies of it aren't looked for. An empty table gives an empty table;
    further columns are ignored.
    """
    rows = written(signed(docs, words), "near-signatures")
    some = rows.filter("n > 0")
    classes = written(some.groupBy("n", "a", "b").agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig")), "near-classes")
    bands = _bands(classes)
    buckets = bands.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last")).filter("pivot < last").select("key", "pivot")
    met = written(bands.join(buckets, "key").select("key", "band", "rep", "pivot"), "near-buckets")
    pairs = met.filter("rep != pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    ids = met.select(F.col("rep").alias("doc_id")).distinct().join(classes.select("doc_id", "n", "a", "b", "sig"), "doc_id")
    # One text per class: rows with the same doc_id can only be told apart by their multiset.
    texts = written(packed_texts(docs, ids.select("doc_id", "n")), "near-texts")
    links = written(verified(pairs, texts, words, threshold), "near-links")
    first = written(components(links), "near-components")

    comp = F.coalesce("component", "rep").alias("comp")
    placed = met.select("key", "band", "rep").join(first, met.rep == first.node, "left").select("key", "band", "rep", comp)
    split = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("key")
    known = texts.join(ids.select("doc_id", "sig"), "doc_id").withColumnRenamed("doc_id", "rep")
    members = placed.join(split, "key").join(known, "rep")
    all_links = links.union(written(_across(members, words, threshold), "near-late-links"))
    final = written(components(all_links), "near-final")

    known = classes.select("n", "a", "b", F.col("doc_id").alias("class_id")).join(
        final, F.col("class_id") == F.col("node"), "left").select("n", "a", "b", "class_id", F.coalesce("component", "class_id").alias("component_id"))
    out = rows.join(known, ["n", "a", "b"], "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"), F.col("n").alias("n_shingles"))
