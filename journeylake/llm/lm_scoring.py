"""Language-model scores of documents: n-grams mixed by deleted interpolation.

The probability of a word after its two predecessors mixes the maximum-likelihood estimates of
three orders with a uniform one,

    P3 = l3 * c(abw)/c(ab) + (1 - l3) * P2,   P2 = l2 * c(bw)/c(b) + (1 - l2) * P1,
    P1 = l1 * c(w)/N + (1 - l1) / (V + 1).

``l3`` and ``l2`` depend on how often their context was seen, in one bucket for every power of
two. One fold of the training documents is deleted from the counts, and expectation-maximisation
on its counts finds the weights; the scores then use the counts of all training documents.

Counts travel packed. Documents are cut into chunks of a few megabytes; a chunk knows its
distinct words, pairs and triples and asks the shards that count them, one row per chunk and
shard, so that a word or pair that stands everywhere costs one entry per chunk. Words get exact
numbers, small for frequent ones; n-grams are compared by the numbers of their words. The triples
of a pair are counted with it, unless both its words are frequent; then each is dealt by itself.
Chunks are stored in buckets by their part, so that only questions and answers are shuffled.
Nothing but the weights, N and V meets the driver.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import documents_of, mixed, shared_folder, shuffle_width, text_bytes, written

#: Text bytes of one chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20
#: Chunks of one part, which one call works on.
PART_CHUNKS = 8
#: Entries that one shard counts at once.
SHARD_ENTRIES = 1 << 21
#: The end of a document, as a word that no text has.
END = b"\n"
#: Buckets of context counts: one for every bit length of a 64-bit count.
BUCKETS = 64

CHUNKS = ("part long, chunk long, held boolean, doc_ids array<bigint>, tests array<boolean>, sizes binary, codes binary, "
          "place binary, words binary, n_words long, counts binary, n_tokens long")
#: A pair's triples follow it: ``follow`` tells how many, ``c`` and ``counts3`` are theirs.
REQUESTS = ("level int, shard int, part long, chunk long, held boolean, a binary, b binary, c binary, counts binary, "
            "follow binary, counts3 binary")
#: Counts of all training documents and, for chunks of the deleted fold, without that fold.
ANSWERS = ("part long, chunk long, held boolean, level int, shard int, ids binary, total binary, main binary, "
           "total3 binary, main3 binary")
EVIDENCE = ("c1", "ctx1", "c2", "ctx2", "c3")


@dataclass(frozen=True)
class Weights:
    """Training tokens and distinct ones, of the counts without the deleted fold and of all, and
    the mixture weights; ``l2`` and ``l3`` by bucket."""

    n_main: int
    v_main: int
    n: int
    v: int
    l1: float
    l2: tuple
    l3: tuple


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64(),
             "array<bigint>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers as compressed byte planes; the planes above the largest are left out."""
    import zstandard

    values = np.ascontiguousarray(values, np.int64)
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view(np.int64).ravel()


def _words_of(data: bytes) -> list[bytes]:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data).split(b" ")


def _hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


# --- chunks -----------------------------------------------------------------------------


def _chunk(number: int, held: bool, ids: list, tests: list, texts: list[bytes]) -> dict:
    import zstandard

    words: list[bytes] = []
    sizes = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = text.lower().split()  # bytes: A-Z only, and exactly the six blanks
        words += own
        words.append(END)
        sizes[i] = len(own) + 1
    coded = pa.array(words, pa.binary()).dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    found = coded.indices.to_numpy()
    # Codes by falling frequency pack well; the words lie in the order of a hash, so that a shard
    # is a range of them, and ``place`` leads from one to the other.
    by_hash, by_count = np.argsort(_hashes(vocabulary), kind="stable"), np.argsort(-np.bincount(found), kind="stable")
    code, place = np.empty(len(by_hash), np.int64), np.empty(len(by_hash), np.int64)
    code[by_count] = place[by_hash] = np.arange(len(by_hash))
    learned = np.repeat(~np.array(tests, bool), sizes)
    counts = np.bincount(found[learned], minlength=len(by_hash))
    return {"part": number // PART_CHUNKS, "chunk": number, "held": held, "doc_ids": ids, "tests": tests, "sizes": pack(sizes),
            "codes": pack(code[found]), "place": pack(place[by_count]),
            "words": zstandard.ZstdCompressor(level=1).compress(b" ".join(vocabulary[i] for i in by_hash)),
            "n_words": len(by_hash), "counts": pack(counts[by_hash]), "n_tokens": len(found)}


def _chunks(most: int):
    """Documents of the deleted fold and all others go into separate chunks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        schema = _schema(CHUNKS)
        number = (TaskContext.get().partitionId() << 32) - 1
        open_chunks = {True: ([], [], []), False: ([], [], [])}
        filled = {True: 0, False: 0}

        def close(held: bool) -> pa.RecordBatch:
            nonlocal number
            number += 1
            row = _chunk(number, held, *open_chunks[held])
            open_chunks[held], filled[held] = ([], [], []), 0
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for i, (doc_id, test, held) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)))):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                if filled[held] and filled[held] + len(text) > most:
                    yield close(held)
                for values, value in zip(open_chunks[held], (doc_id, test, text)):
                    values.append(value)
                filled[held] += len(text) + 1
        for held in (True, False):
            if filled[held]:
                yield close(held)

    return cut


# --- counting in shards -------------------------------------------------------------------


def _ask_words(shards: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        schema = _schema(REQUESTS)
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = _words_of(row["words"]), unpack(row["counts"])
                shard = (_hashes(words) / 2.0**64 * shards).astype(np.int64).clip(0, shards - 1)
                cuts = np.flatnonzero(np.diff(shard, prepend=-1))
                rows = [{"level": 1, "shard": int(shard[i]), "part": row["part"], "chunk": row["chunk"], "held": row["held"],
                         "a": zstandard.ZstdCompressor(level=1).compress(b" ".join(words[i:j])), "counts": pack(counts[i:j])}
                        for i, j in zip(cuts, [*cuts[1:], len(words)])]
                yield pa.RecordBatch.from_pylist(rows, schema)

    return ask


def _as_one(columns: list[np.ndarray]) -> np.ndarray | None:
    """Rows of non-negative values as single numbers in the same order; None where 63 bits don't
    hold them."""
    bits = [int(column.max(initial=0)).bit_length() for column in columns]
    if sum(bits) > 63:
        return None
    key = columns[0].astype(np.int64)
    for column, width in zip(columns[1:], bits[1:]):
        key <<= width
        key |= column
    return key


def _number(columns: list[np.ndarray]) -> np.ndarray:
    """The same number for the same row of non-negative values, from 0."""
    import pandas as pd

    key = _as_one(columns)
    if key is not None:
        return pd.factorize(key)[0].astype(np.int64)
    codes = pd.factorize(columns[0])[0].astype(np.int64)
    for column in columns[1:]:
        other = pd.factorize(column)[0].astype(np.int64)
        codes = pd.factorize(codes * (int(other.max(initial=0)) + 1) + other)[0].astype(np.int64)
    return codes


def _order(columns: list[np.ndarray]) -> np.ndarray:
    """Places of distinct rows of non-negative values in their order."""
    key = _as_one(columns)
    return np.lexsort(columns[::-1]) if key is None else np.argsort(key)


def _spread(row: dict, names: tuple[str, str], codes: np.ndarray, total: np.ndarray, main: np.ndarray) -> dict:
    """The counts of a row's entries; only the deleted fold needs both."""
    return {names[0]: pack(total[codes]), names[1]: pack(main[codes]) if row["held"] else None}


def _counted(rows: list[dict], codes: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Totals by code, those without the deleted fold, and each row's codes."""
    counts = [unpack(r[name]) for r in rows]
    sizes = [len(c) for c in counts]
    learned = np.concatenate(counts).astype(np.float64)
    deleted = np.repeat([r["held"] for r in rows], sizes)
    total, main = np.bincount(codes, learned), np.bincount(codes, np.where(deleted, 0.0, learned))
    return total.astype(np.int64), main.astype(np.int64), np.split(codes, np.cumsum(sizes)[:-1])


def _joined(rows: list[dict], name: str) -> np.ndarray:
    return np.concatenate([unpack(r[name]) for r in rows])


def _starts(rows: list[dict]) -> np.ndarray:
    """First words, which lie as differences within each row."""
    return np.concatenate([np.cumsum(unpack(r["a"])) for r in rows])


def _count_shard(shards: int):
    def count(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        level, shard = rows[0]["level"], rows[0]["shard"]
        if level == 1:
            words = [w for r in rows for w in _words_of(r["a"])]
            codes = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
        else:
            codes = _number([_starts(rows), _joined(rows, "b"), *([_joined(rows, "c")] if level == 3 else [])])
        total, main, mine = _counted(rows, codes, "counts")
        out = [{"part": r["part"], "chunk": r["chunk"], "held": r["held"], "level": level, "shard": shard,
                **_spread(r, ("total", "main"), m, total, main)} for r, m in zip(rows, mine)]
        if level == 1:
            rank = np.empty(len(total), np.int64)
            rank[np.argsort(-total, kind="stable")] = np.arange(len(total))
            for row, m in zip(out, mine):
                row["ids"] = pack(rank[m] * shards + shard + 1)
            sums = {"total": pack(np.array([total.sum(), (total > 0).sum()])), "main": pack(np.array([main.sum(), (main > 0).sum()]))}
            out.append({"part": -1, "chunk": -1, "held": False, "level": 1, "shard": shard, **sums})
        elif level == 2:
            triples = _number([np.repeat(codes, _joined(rows, "follow")), _joined(rows, "c")])
            total3, main3, mine3 = _counted(rows, triples, "counts3")
            for row, m in zip(out, mine3):
                row |= _spread(row, ("total3", "main3"), m, total3, main3)
        return pa.Table.from_pylist(out, _schema(ANSWERS))

    return count


# --- a chunk with its answers ---------------------------------------------------------------


class _Opened:
    """The tokens of a chunk with the numbers of its words, its distinct pairs and triples."""

    def __init__(self, row: dict, answers: list[dict], bound: int):
        import pandas as pd

        self.answers = sorted(answers, key=lambda r: (r["level"], r["shard"]))
        codes, self.sizes, self.place = unpack(row["codes"]), unpack(row["sizes"]), unpack(row["place"])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.codes, self.end = codes, codes[self.sizes[0] - 1]
        # Number 0 stands before the first word of a document; there are as many as ends.
        self.ids = np.concatenate([[0], self._got(1, "ids")[self.place]])
        totals = self._got(1, "total")[self.place]
        frequent = np.concatenate([[totals[self.end]], totals]) > bound
        now = codes + 1
        before = np.concatenate([[0], now[:-1]])
        before[self.starts] = 0
        width = row["n_words"] + 1
        self.pair, pairs = pd.factorize(before * width + now)
        self.a, self.b = pairs // width, pairs % width
        self.inner = np.ones(len(codes), bool)  # positions with two predecessors, the blank one included
        self.inner[self.starts] = False
        context = np.concatenate([[0], self.pair[:-1]])
        self.triple, triples = pd.factorize((context * width + now)[self.inner])
        self.context, self.c = triples // width, triples % width
        self.alone = (frequent[self.a] & frequent[self.b])[self.context]
        self.learned = np.repeat(~np.array(row["tests"], bool), self.sizes)

    def _got(self, level: int, name: str) -> np.ndarray:
        found = [unpack(r[name]) for r in self.answers if r["level"] == level]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def dealt(self, shards: int) -> tuple[np.ndarray, ...]:
        """Orders in which pairs, their triples and triples by themselves are asked for, with
        the shards of the first and the last."""
        def shard(*columns: np.ndarray) -> np.ndarray:
            h = np.full(len(columns[0]), len(columns), np.uint64)
            for column in columns:
                h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
            return (h % np.uint64(shards)).astype(np.int64)

        a, b, c = self.ids[self.a], self.ids[self.b], self.ids[self.c]
        of_pair = shard(a, b)
        pairs = _order([of_pair, a, b])
        at = np.empty(len(pairs), np.int64)
        at[pairs] = np.arange(len(pairs))
        theirs, alone = np.flatnonzero(~self.alone), np.flatnonzero(self.alone)
        follow = theirs[_order([at[self.context[theirs]], c[theirs]])]
        a3, b3 = a[self.context[alone]], b[self.context[alone]]
        of_triple = shard(a3, b3, c[alone])
        order = _order([of_triple, a3, b3, c[alone]])
        return pairs, of_pair[pairs], follow, alone[order], of_triple[order]

    def requests(self, row: dict, shards: int) -> list[dict]:
        pairs, of_pair, follow, alone, of_triple = self.dealt(shards)
        a, b, c = self.ids[self.a], self.ids[self.b], self.ids[self.c]
        counts = np.bincount(self.pair[self.learned], minlength=len(a))
        counts3 = np.bincount(self.triple[self.learned[self.inner]], minlength=len(c))
        n_follow = np.bincount(self.context[follow], minlength=len(a))
        upto = np.concatenate([[0], np.cumsum(n_follow[pairs])])
        common = {"part": row["part"], "chunk": row["chunk"], "held": row["held"]}
        out = []
        for i, j in _runs(of_pair):
            now, then = pairs[i:j], follow[upto[i] : upto[j]]
            out.append({**common, "level": 2, "shard": int(of_pair[i]), "a": pack(np.diff(a[now], prepend=0)), "b": pack(b[now]),
                        "counts": pack(counts[now]), "follow": pack(n_follow[now]), "c": pack(c[then]), "counts3": pack(counts3[then])})
        for i, j in _runs(of_triple):
            now = alone[i:j]
            out.append({**common, "level": 3, "shard": int(of_triple[i]), "a": pack(np.diff(a[self.context[now]], prepend=0)),
                        "b": pack(b[self.context[now]]), "c": pack(c[now]), "counts": pack(counts3[now])})
        return out

    def evidence(self, kind: str, shards: int) -> dict[str, np.ndarray]:
        """Counts behind each position: word, pair, triple, and the contexts of the last two."""
        pairs, _, follow, alone, _ = self.dealt(shards)
        of_pairs, of_triples = np.empty(len(self.a), np.int64), np.empty(len(self.c), np.int64)
        of_pairs[pairs] = self._got(2, kind)
        of_triples[follow] = self._got(2, f"{kind}3")
        of_triples[alone] = self._got(3, kind)
        words = self._got(1, kind)[self.place]
        c1, c2 = words[self.codes], of_pairs[self.pair]
        ctx1 = np.concatenate([[0], c1[:-1]])
        ctx1[self.starts] = words[self.end]
        ctx2, c3 = np.concatenate([[0], c2[:-1]]), c2.copy()
        ctx2[self.starts] = ctx1[self.starts]
        c3[self.inner] = of_triples[self.triple]
        return {"c1": c1, "ctx1": ctx1, "c2": c2, "ctx2": ctx2, "c3": c3}


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(values, prepend=-1))
    return zip(cuts, [*cuts[1:], len(values)])


def _per_chunk(work, ddl: str):
    """A cogroup function that gives each chunk of a part and its answers to ``work``, for a list of rows."""
    def act(left: pa.Table, right: pa.Table) -> pa.Table:
        answers: dict[int, list[dict]] = {}
        for row in right.to_pylist():
            answers.setdefault(row["chunk"], []).append(row)
        schema = _schema(ddl)
        done = [pa.RecordBatch.from_pylist(work(row, answers.pop(row["chunk"])), schema) for row in left.to_pylist()]
        return pa.Table.from_batches(done, schema)

    return act


# --- the mixture ----------------------------------------------------------------------------


def _over(count: np.ndarray, context) -> np.ndarray:
    context = np.asarray(context, np.float64)
    return np.divide(count, context, out=np.zeros(np.shape(count)), where=context > 0)


def _buckets(context: np.ndarray) -> np.ndarray:
    return np.frexp(context.astype(np.float64))[1].clip(0, BUCKETS - 1)


def mixture(e: dict[str, np.ndarray], n: int, v: int, weights: Weights) -> dict[str, np.ndarray]:
    """Probability of every position and the shares of it that stop at each order."""
    b2, b3 = _buckets(e["ctx1"]), _buckets(e["ctx2"])
    l1, l2, l3 = (weights.l1 if n else 0.0), np.array(weights.l2)[b2], np.array(weights.l3)[b3]
    at3 = l3 * _over(e["c3"], e["ctx2"])
    at2 = (1 - l3) * l2 * _over(e["c2"], e["ctx1"])
    rest = (1 - l3) * (1 - l2)
    at1 = rest * l1 * (e["c1"] / n if n else 0.0)
    at0 = rest * (1 - l1) / (v + 1)
    return {"p": at3 + at2 + at1 + at0, "at3": at3, "at2": at2, "at1": at1, "at0": at0, "b2": b2, "b3": b3}


STEP = "level int, bucket int, hits double, tries double"


def _expect(weights: Weights):
    """Expected stops at each order, by bucket, over packed evidence."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, tries = np.zeros((4, BUCKETS)), np.zeros((4, BUCKETS))
        for batch in batches:
            for row in batch.to_pylist():
                m = mixture({name: unpack(row[name]) for name in EVIDENCE}, weights.n_main, weights.v_main, weights)
                r3, r2, r1, r0 = (m[k] / m["p"] for k in ("at3", "at2", "at1", "at0"))
                hits[3] += np.bincount(m["b3"], r3, BUCKETS)
                tries[3] += np.bincount(m["b3"], minlength=BUCKETS)
                hits[2] += np.bincount(m["b2"], r2, BUCKETS)
                tries[2] += np.bincount(m["b2"], r2 + r1 + r0, BUCKETS)
                hits[1, 0] += r1.sum()
                tries[1, 0] += (r1 + r0).sum()
                hits[0, 0] += np.log(m["p"]).sum()
                tries[0, 0] += len(r3)
        rows = [{"level": i, "bucket": j, "hits": hits[i, j], "tries": tries[i, j]}
                for i in range(4) for j in range(BUCKETS) if tries[i, j]]
        yield pa.RecordBatch.from_pylist(rows, _schema(STEP))

    return step


def _learn(evidence: DataFrame, start: Weights, rounds: int, gain: float) -> Weights:
    """Weights by expectation-maximisation. Every weight starts at a half and keeps one try at a
    half as a prior, so a bucket without held-out counts stays there and none reaches 0 or 1. An
    unseen context has weight 0."""
    weights, likelihood = start, -np.inf
    for _ in range(rounds):
        rows = evidence.mapInArrow(_expect(weights), STEP).groupBy("level", "bucket").agg(
            F.sum("hits").alias("hits"), F.sum("tries").alias("tries")).collect()
        hits, tries = np.full((4, BUCKETS), 0.5), np.ones((4, BUCKETS))
        for r in rows:
            hits[r["level"], r["bucket"]] += r["hits"]
            tries[r["level"], r["bucket"]] += r["tries"]
        if tries[0, 0] == 1:
            break
        new = hits / tries
        new[:, 0] *= [1, 1, 0, 0]
        weights = Weights(start.n_main, start.v_main, start.n, start.v, float(new[1, 0]), tuple(new[2]), tuple(new[3]))
        now = (hits[0, 0] - 0.5) / (tries[0, 0] - 1)
        if now - likelihood < gain:
            break
        likelihood = now
    return weights


# --- the operator ---------------------------------------------------------------------------


def _stored(chunks: DataFrame) -> DataFrame:
    """Chunks in the shared folder, bucketed by part: no later cogroup shuffles them again."""
    spark = chunks.sparkSession
    name = f"lm_chunks_{uuid.uuid4().hex}"
    # About one bucket for every task that writes.
    buckets = min(max(chunks.rdd.getNumPartitions(), shuffle_width(spark)), 100_000)
    chunks.write.bucketBy(buckets, "part").option("path", os.path.join(shared_folder(spark), name)).saveAsTable(name)
    return spark.table(name)


@dataclass(frozen=True)
class Counted:
    chunks: DataFrame
    answers: DataFrame
    shards: int
    bound: int
    weights: Weights


#: What a chunk needs to be opened again; its words stay behind.
OPENED = ("part", "chunk", "held", "doc_ids", "tests", "sizes", "codes", "place", "n_words")


def count_and_learn(docs: DataFrame, test: Column, held: Column, rounds: int = 12, gain: float = 1e-4,
                    chunk_bytes: int = CHUNK_BYTES, shard_entries: int = SHARD_ENTRIES) -> Counted:
    """Counts of all n-grams and the mixture weights. ``test`` marks documents that are not
    learned from, ``held`` the deleted fold of the others; both are expressions on ``doc_id``."""
    test, held = F.coalesce(test, F.lit(False)), F.coalesce(held, F.lit(False))
    rows = documents_of(docs).select("doc_id", "text", test.alias("test"), (held & ~test).alias("held"))
    chunks = _stored(rows.mapInArrow(_chunks(chunk_bytes), CHUNKS))
    size = chunks.agg(F.sum("n_words").alias("words"), F.sum("n_tokens").alias("tokens")).first()
    word_shards, shards = (-(-(size[k] or 0) // shard_entries) or 1 for k in ("words", "tokens"))
    bound = shard_entries // 8
    asked = chunks.select("part", "chunk", "held", "words", "counts").mapInArrow(_ask_words(word_shards), REQUESTS)
    words = written(asked.groupBy("shard").applyInArrow(_count_shard(word_shards), ANSWERS), "lm-words")
    sums = np.zeros((2, 2), np.int64)
    # Four numbers from each shard.
    for r in words.filter("chunk = -1").toLocalIterator():
        sums += [unpack(r["main"]), unpack(r["total"])]
    words, chunks = words.filter("chunk >= 0"), chunks.select(*OPENED)

    def ask(row: dict, found: list[dict]) -> list[dict]:
        return _Opened(row, found, bound).requests(row, shards)

    asked = chunks.groupBy("part").cogroup(words.groupBy("part")).applyInArrow(_per_chunk(ask, REQUESTS), REQUESTS)
    answers = words.unionByName(
        written(asked.groupBy("level", "shard").applyInArrow(_count_shard(shards), ANSWERS), "lm-grams"))

    def show(row: dict, found: list[dict]) -> list[dict]:
        e = _Opened(row, found, bound).evidence("main", shards)
        return [{name: pack(e[name]) for name in EVIDENCE}]

    kinds = ", ".join(f"{name} binary" for name in EVIDENCE)
    evidence = written(chunks.filter("held").groupBy("part").cogroup(answers.filter("held").groupBy("part"))
                       .applyInArrow(_per_chunk(show, kinds), kinds), "lm-evidence")
    half = (0.0, *[0.5] * (BUCKETS - 1))
    start = Weights(*map(int, sums.ravel()), 0.5, half, half)
    return Counted(chunks, answers, shards, bound, _learn(evidence, start, rounds, gain))


SCORES = "doc_id long, test boolean, n_tokens long, n_known long, base_score double, score double"


def score_documents(docs: DataFrame, test: Column, held: Column, rounds: int = 12, gain: float = 1e-4,
                    chunk_bytes: int = CHUNK_BYTES, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """One row per document: ``n_tokens`` with the end, ``n_known`` of them seen in training,
    ``train_tokens``, and two log10 probabilities, ``base_score`` by add-one unigrams and
    ``score`` by the mixture.

    Null text counts as empty and has one token, its end. A document without an id is scored
    like any other and, as its fold is unknown, learned from. Repeated rows are scored and
    counted one by one, texts of any length whole; columns other than ``doc_id`` and ``text``
    don't matter, and an empty table gives no rows.
    """
    model = count_and_learn(docs, test, held, rounds, gain, chunk_bytes, shard_entries)
    shards, bound, weights = model.shards, model.bound, model.weights

    def score(row: dict, answers: list[dict]) -> list[dict]:
        opened = _Opened(row, answers, bound)
        e = opened.evidence("total", shards)
        base = np.log10((e["c1"] + 1) / (weights.n + weights.v + 1))
        model_p = np.log10(mixture(e, weights.n, weights.v, weights)["p"])
        sums = [np.add.reduceat(x, opened.starts) for x in ((e["c1"] > 0).astype(np.int64), base, model_p)]
        return [{"doc_id": d, "test": t, "n_tokens": int(n), "n_known": int(k), "base_score": float(b), "score": float(s)}
                for d, t, n, k, b, s in zip(row["doc_ids"], row["tests"], opened.sizes, *sums)]

    # The counts without the deleted fold have done their work.
    answers = model.answers.select("part", "chunk", "level", "shard", "ids", "total", "total3")
    scored = model.chunks.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_per_chunk(score, SCORES), SCORES)
    return scored.withColumn("train_tokens", F.lit(weights.n).cast("long"))
