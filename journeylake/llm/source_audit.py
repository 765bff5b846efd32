"""How far the sources of a language diverge in the terms they use.

Terms that stand in enough documents of their language are kept. Sorted, they are built into
minimal acyclic transducers: automata that share prefixes and suffixes, whose transitions carry
weights that add up to a term's place in lexicographic order. A second pass streams the text
through them and counts places instead of strings; the places also break ties and lead back to
the terms. A transducer covers a range of a language's terms and stays small whatever the
vocabulary; the text's terms are dealt to the ranges, chunk by chunk, and salted, so that neither
a large language nor a large source meets in one task. All arithmetic is on integers.
"""

from __future__ import annotations

import bisect
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import text_bytes, written
from .lm_scoring import pack, unpack

#: Text bytes of one language that one chunk holds, and bytes of all chunks open at once.
CHUNK_BYTES, OPEN_BYTES = 8 << 20, 32 << 20
#: Bytes of terms in one transducer.
RANGE_BYTES = 256 << 10
#: Entries that meet one copy of a transducer, and counts that are compared at once.
SALT_ENTRIES, BLOCK_COUNTS = 4 << 20, 2 << 20
#: Fixed values of the measure: scale and smoothing of the proportions.
SCALE, SMOOTHING = 1_000_000_000, 5

#: A-Z folded, letters and bytes beyond ASCII kept, everything else a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

SEEN = pa.schema([("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64())])
PLACED = pa.schema([("lang", pa.string()), ("term", pa.string()), ("bytes", pa.int64()), ("slice", pa.int32()), ("upto", pa.int64())])
RANGES = pa.schema([("lang", pa.string()), ("range", pa.int64()), ("first", pa.binary()), ("n_terms", pa.int64()), ("transducer", pa.binary())])
DEALT = pa.schema([("lang", pa.string()), ("range", pa.int64()), ("salt", pa.int32()), ("sources", pa.list_(pa.string())),
                   ("terms", pa.binary()), ("term", pa.binary()), ("source", pa.binary()), ("counts", pa.binary())])
COUNTED = pa.schema([("lang", pa.string()), ("range", pa.int64()), ("source", pa.string()), ("n", pa.int64()),
                     ("places", pa.binary()), ("counts", pa.binary())])
FOUND = pa.schema([("part", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("item", pa.string()),
                   ("value", pa.int64()), ("place", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.list_(pa.string()): "array<string>"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


# --- the transducer ---------------------------------------------------------------------


def build_transducer(terms: Iterable[bytes]) -> bytes:
    """The minimal acyclic transducer of sorted, different terms.

    States that can't change any more are looked up by their finality and transitions, and equal
    ones become one. A transition weighs the number of terms that come before those behind it.
    """
    known: dict[tuple, int] = {}
    below = [0]  # terms that a state accepts
    open_states: list[list] = [[False, []]]
    labels = bytearray()

    def frozen(state: list) -> int:
        key = (state[0], tuple(state[1]))
        number = known.get(key)
        if number is None:
            number = known[key] = len(below)
            below.append(state[0] + sum(below[target] for _, target in state[1]))
        return number

    def close(depth: int) -> None:
        while len(labels) > depth:
            target = frozen(open_states.pop())
            open_states[-1][1].append((labels.pop(), target))

    for term in terms:
        same = 0
        for x, y in zip(term, labels):
            if x != y:
                break
            same += 1
        close(same)
        for label in term[same:]:
            labels.append(label)
            open_states.append([False, []])
        open_states[-1][0] = True
    close(0)
    root = frozen(open_states[0])
    final = np.zeros(len(below), np.int64)
    rows = []
    for (accepts, transitions), number in known.items():
        final[number] = accepts
        weight = int(accepts)
        for label, target in transitions:
            rows.append((number, label, target, weight))
            weight += below[target]
    columns = np.array(rows, np.int64).reshape(-1, 4).T
    parts = [pack(x) for x in (np.array([root]), final, *columns)]
    return struct.pack("<6q", *map(len, parts)) + b"".join(parts)


class Transducer:
    """Runs many terms through a transducer at once."""

    def __init__(self, data: bytes):
        sizes = struct.unpack_from("<6q", data)
        ends = 48 + np.cumsum(sizes)
        (root,), self.final, self.state, self.label, self.target, self.weight = (
            unpack(data[end - size : end]) for end, size in zip(ends, sizes))
        self.root = int(root)
        # A dense table over the labels in use; state 0 is the dead one.
        used = np.unique(self.label)
        self.classes = np.zeros(256, np.int64)
        self.classes[used] = np.arange(1, len(used) + 1)
        self.next = np.zeros((len(self.final), len(used) + 1), np.int32)
        self.adds = np.zeros(self.next.shape, np.int32)
        self.next[self.state, self.classes[self.label]] = self.target
        self.adds[self.state, self.classes[self.label]] = self.weight

    def places(self, terms: list[bytes]) -> np.ndarray:
        """Each term's place in lexicographic order, -1 for terms that aren't there."""
        sizes = np.fromiter(map(len, terms), np.int64, len(terms))
        starts = np.cumsum(sizes) - sizes
        data = self.classes[np.frombuffer(b"".join(terms), np.uint8)]
        state, place = np.full(len(terms), self.root, np.int64), np.zeros(len(terms), np.int64)
        live, depth = np.flatnonzero(sizes > 0), 0
        while len(live):
            label = data[starts[live] + depth]
            place[live] += self.adds[state[live], label]
            state[live] = self.next[state[live], label]
            depth += 1
            live = live[(state[live] > 0) & (sizes[live] > depth)]
        return np.where(self.final[state] > 0, place, -1)

    def term(self, place: int) -> bytes:
        out, state = bytearray(), self.root
        while place or not self.final[state]:
            i, j = np.searchsorted(self.state, [state, state + 1])
            k = i + int(np.searchsorted(self.weight[i:j], place, "right")) - 1
            place -= int(self.weight[k])
            out.append(int(self.label[k]))
            state = int(self.target[k])
        return bytes(out)


# --- passes over the text ---------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, list[str], list[bytes]]]:
    """Sources and texts of one language at a time."""
    opened: dict[str, tuple[list, list]] = {}
    filled: dict[str, int] = {}
    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        for i, (lang, source) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            sources, texts = opened.setdefault(lang, ([], []))
            sources.append(source)
            texts.append(data[offsets[i] : offsets[i + 1]].tobytes())
            filled[lang] = filled.get(lang, 0) + len(texts[-1]) + 1
            full = [lang] if filled[lang] >= most else list(opened) if sum(filled.values()) >= OPEN_BYTES else []
            for name in full:
                filled.pop(name)
                yield name, *opened.pop(name)
    for name, (sources, texts) in opened.items():
        yield name, sources, texts


def _terms(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct terms, and the number and document of every occurrence."""
    words: list[bytes] = []
    sizes = []
    for text in texts:
        own = text.translate(FOLD).split()
        words += own
        sizes.append(len(own))
    coded = pa.array(words, pa.binary()).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(texts)), sizes)


def _document_counts(most: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, _, texts in _chunks(batches, most):
            terms, codes, docs = _terms(texts)
            once = np.unique(codes * len(texts) + docs) // len(texts)
            counts = np.bincount(once, minlength=len(terms))
            for i in range(0, len(terms), 1 << 16):
                some = pa.array(terms[i : i + (1 << 16)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some), pa.string()), some, pa.array(counts[i : i + (1 << 16)], pa.int64())], schema=SEEN)

    return count


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted terms with the slice they lie in and the bytes of their language before them there."""
    from pyspark import TaskContext

    here = TaskContext.get().partitionId()
    lang, size = None, 0
    for batch in batches:
        upto = []
        for name, length in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if name != lang:
                lang, size = name, 0
            upto.append(size)
            size += length + 1
        columns = [batch.column(0), batch.column(1), batch.column(2).cast(pa.int64()), pa.array([here] * len(upto), pa.int32()), pa.array(upto, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, schema=PLACED)


def _build(table: pa.Table) -> pa.Table:
    terms = sorted(term.encode() for term in table["term"].to_pylist())
    head = {name: table[name][0].as_py() for name in ("lang", "range")}
    return pa.Table.from_pylist([{**head, "first": terms[0], "n_terms": len(terms), "transducer": build_transducer(terms)}], RANGES)


def _ranges(kept: DataFrame, range_bytes: int) -> DataFrame:
    """Transducers of consecutive terms, each of about ``range_bytes`` of a language's sorted
    terms, however the sort was partitioned: slices know their bytes, sums over them give every
    term its distance from the language's first."""
    sized = kept.select("lang", "term", F.octet_length("term").alias("bytes"))
    placed = written(sized.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(_place, _ddl(PLACED)), "audit-placed")
    earlier = Window.partitionBy("lang").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = placed.groupBy("lang", "slice").agg(F.sum(F.col("bytes") + 1).alias("size")).select(
        "lang", "slice", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("earlier"))
    number = F.floor((F.col("earlier") + F.col("upto")) / range_bytes)
    return written(placed.join(slices, ["lang", "slice"]).select("lang", "term", number.alias("range"))
                   .groupBy("lang", "range").applyInArrow(_build, _ddl(RANGES)), "audit-ranges")


def _deal(firsts: dict[str, tuple[list[bytes], list[int]]], salts: int, most: int):
    """A chunk's terms, once each, to the ranges they fall into, with a count for every source."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId()
        for lang, sources, texts in _chunks(batches, most):
            salt += 1
            if lang not in firsts:
                continue
            terms, codes, docs = _terms(texts)
            order = sorted(range(len(terms)), key=terms.__getitem__)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            terms = [terms[i] for i in order]
            names = sorted(set(sources))
            numbers = {name: i for i, name in enumerate(names)}
            source = np.array([numbers[s] for s in sources], np.int64)[docs]
            entries, counts = np.unique(rank[codes] * len(names) + source, return_counts=True)
            term, source = entries // len(names), entries % len(names)
            starts, ranges = firsts[lang]
            cuts = [0, *(bisect.bisect_left(terms, first) for first in starts[1:]), len(terms)]
            for number, i, j in zip(ranges, cuts, cuts[1:]):
                a, b = np.searchsorted(term, [i, j])
                if a < b:
                    yield pa.RecordBatch.from_pylist([{
                        "lang": lang, "range": number, "salt": salt % salts, "sources": names,
                        "terms": zstandard.ZstdCompressor(level=1).compress(b" ".join(terms[i:j])),
                        "term": pack(np.diff(term[a:b], prepend=i)), "source": pack(source[a:b]), "counts": pack(counts[a:b])}], DEALT)

    return deal


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(keys, return_inverse=True)
    sums = np.zeros(len(found), np.int64)
    np.add.at(sums, at, counts)
    return found, sums


def _recount(left: pa.Table, right: pa.Table) -> pa.Table:
    """Streams the terms dealt to one copy of a transducer through it."""
    import zstandard

    if not left.num_rows:
        return COUNTED.empty_table()
    transducer, n = Transducer(right["transducer"][0].as_py()), right["n_terms"][0].as_py()
    numbers: dict[str, int] = {}
    keys, counts, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), []
    for i in range(left.num_rows):
        row = left.slice(i, 1).to_pylist()[0]
        place = transducer.places(zstandard.ZstdDecompressor().decompress(row["terms"]).split(b" "))[np.cumsum(unpack(row["term"]))]
        mine = np.array([numbers.setdefault(s, len(numbers)) for s in row["sources"]])[unpack(row["source"])]
        waiting.append((mine[place >= 0] * n + place[place >= 0], unpack(row["counts"])[place >= 0]))
        if i == left.num_rows - 1 or sum(len(k) for k, _ in waiting) > SALT_ENTRIES:
            keys, counts = _summed(np.concatenate([keys, *(k for k, _ in waiting)]), np.concatenate([counts, *(c for _, c in waiting)]))
            waiting = []
    head = {name: left[name][0].as_py() for name in ("lang", "range")}
    out = []
    for source, number in numbers.items():
        i, j = np.searchsorted(keys, [number * n, (number + 1) * n])
        if i < j:
            out.append({**head, "source": source, "n": int(counts[i:j].sum()),
                        "places": pack(np.diff(keys[i:j] - number * n, prepend=0)), "counts": pack(counts[i:j])})
    return pa.Table.from_pylist(out, COUNTED)


# --- the comparison ---------------------------------------------------------------------


def proportions(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * counts / total) by long division in steps of a thousand, so that no
    product leaves 64 bits while totals stay below 9e15."""
    out, rest = counts // total, counts % total
    for _ in range(3):
        out = out * 1000 + rest * 1000 // total
        rest = rest * 1000 % total
    return out + 1


def _compare(top: int):
    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return FOUND.empty_table()
        rows = left.to_pylist()
        lang, v, before = rows[0]["lang"], rows[0]["v"], rows[0]["before"]
        totals: dict[str, int] = {r["source"]: r["total"] for r in rows}
        names = sorted(totals)
        numbers = {name: i for i, name in enumerate(names)}
        n = right["n_terms"][0].as_py() if right.num_rows else 0
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for row in rows:
            if row["places"] is not None:
                # By place first, so that a block of places is a range.
                keys = np.concatenate([keys, np.cumsum(unpack(row["places"])) * len(names) + numbers[row["source"]]])
                counts = np.concatenate([counts, unpack(row["counts"])])
        keys, counts = _summed(keys, counts)
        group = np.array([totals[name] for name in names], np.int64)
        apart = np.zeros((len(names), len(names)), np.int64)
        best: list[list[tuple[int, int]]] = [[] for _ in names]
        step = max(1, BLOCK_COUNTS // len(names))
        for start in range(0, n, step):
            width = min(step, n - start)
            i, j = np.searchsorted(keys, [start * len(names), (start + width) * len(names)])
            table = np.zeros((width, len(names)), np.int64)
            table.ravel()[keys[i:j] - start * len(names)] = counts[i:j]
            table = table.T
            p = proportions(table + SMOOTHING, (group + SMOOTHING * v)[:, None])
            q = proportions(table.sum(axis=0) + SMOOTHING, np.int64(group.sum() + SMOOTHING * v))
            for k in range(len(names)):
                apart[k, k + 1 :] += np.abs(p[k + 1 :] - p[k]).sum(axis=1)
                higher = np.flatnonzero((table[k] > 0) & (p[k] > q))
                value = p[k][higher] - q[higher]
                first = np.lexsort((higher, -value))[:top]
                found = best[k] + [(-int(value[x]), start + int(higher[x])) for x in first]
                best[k] = sorted(found)[:top]
        out = [{"part": "pair", "lang": lang, "source": names[a], "item": names[b], "value": int(apart[a, b]), "place": None}
               for a in range(len(names)) for b in range(a + 1, len(names))]
        if n:
            transducer = Transducer(right["transducer"][0].as_py())
            out += [{"part": "term", "lang": lang, "source": name, "item": transducer.term(place).decode(), "value": -value,
                     "place": before + place} for name, found in zip(names, best) for value, place in found]
        return pa.Table.from_pylist(out, FOUND)

    return compare


def audit_sources(docs: DataFrame, least_docs: int = 30, top: int = 50, chunk_bytes: int = CHUNK_BYTES,
                  range_bytes: int = RANGE_BYTES, salt_entries: int = SALT_ENTRIES) -> DataFrame:
    """lang, source, part, item, value and rank of every (lang, source) that occurs.

    Part ``pair`` has a row for every other source of the language: the sum over the kept terms
    of the differences of their proportions. Part ``term`` has the ``top`` terms whose proportion
    in the source is above that in the whole language. Null text, lang and source count as
    empty strings, which are a language and a source of their own; every row is a document,
    repeated ones too; texts count whole. A language without kept terms has pairs of value 0 and
    no terms. An empty table gives no rows. Other columns, a ``term`` or ``range`` say, don't matter.
    """
    texts = docs.select(*[F.coalesce(name, F.lit("")).alias(name) for name in ("lang", "source", "text")])
    seen = texts.mapInArrow(_document_counts(chunk_bytes), _ddl(SEEN)).groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.count(F.lit(1)).alias("chunks"))
    kept = written(seen.filter(F.col("docs") >= least_docs).select("lang", "term", "chunks"), "audit-kept")
    entries = kept.agg(F.sum("chunks")).first()[0] or 0
    ranges = _ranges(kept, range_bytes)
    # One first term for every quarter of a megabyte of vocabulary.
    firsts: dict[str, tuple[list[bytes], list[int]]] = {}
    for r in ranges.select("lang", "range", "first").orderBy("lang", "range").toLocalIterator():
        for values, value in zip(firsts.setdefault(r["lang"], ([], [])), (bytes(r["first"]), r["range"])):
            values.append(value)
    salts = -(-entries // salt_entries) or 1
    dealt = texts.mapInArrow(_deal(firsts, salts, chunk_bytes), _ddl(DEALT))
    copies = ranges.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keys = ("lang", "range", "salt")
    counted = written(dealt.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(_recount, _ddl(COUNTED)), "audit-counts")

    totals = texts.select("lang", "source", F.lit(0).alias("n")).distinct().unionByName(counted.select("lang", "source", "n")).groupBy(
        "lang", "source").agg(F.sum("n").alias("total"))
    upto = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.select("lang", "range", F.sum("n_terms").over(Window.partitionBy("lang")).alias("v"),
                           F.coalesce(F.sum("n_terms").over(upto), F.lit(0)).alias("before"))
    # Every source of a language meets each of its ranges, also where it has no count.
    met = totals.join(placed, "lang", "left").fillna({"range": -1, "v": 0, "before": 0}).join(
        counted.drop("n"), ["lang", "range", "source"], "left")
    found = written(met.groupBy("lang", "range").cogroup(ranges.groupBy("lang", "range")).applyInArrow(_compare(top), _ddl(FOUND)), "audit-found")
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.union(pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    by_source = Window.partitionBy("lang", "source")
    pairs = pairs.withColumn("rank", F.row_number().over(by_source.orderBy(F.desc("value"), "item"))).withColumn("part", F.lit("pair"))
    terms = found.filter("part = 'term'").withColumn(
        "rank", F.row_number().over(by_source.orderBy(F.desc("value"), "place"))).filter(F.col("rank") <= top)
    columns = ("lang", "source", "part", "item", "value", "rank")
    return pairs.select(*columns).unionByName(terms.select(*columns))
