"""Every operator against a brute-force version, and on nulls, empty and repeated rows, empty
tables, long texts and tables with further columns."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from journeylake.llm import embeddings, exact_dedup, graph, line_dedup, minhash, mixing, packing, quality, suffix_dedup, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, start int, name string, copies int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 300)) for _ in range(n))


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, None, None if i % 3 else f"s{i % 4}", None, "x", 1, "y", 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


ODD = [None, "", "   ", "\n\n", "a", "A", "é É", "a b c d", prose(1, 400), prose(1, 400).upper(), prose(2, 30_000), "x" * 50_000, "\n".join(["same line"] * 50),
       "end <|endoftext|> of", "ﬁ Σας ١٢ 東京", prose(1, 400)]
IDS = [5, 3, 3, 9, 1, 2, 7, 8, 20, 21, 30, 31, 32, 33, 34, 20]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD, IDS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# 1
def test_token_counts(odd, none):
    scores = {"▁": -4.0, "▁a": -3.0, "alpha": -2.0, "be": -2.5, "ta": -2.5, "beta": -6.0, "a": -5.0, "x": -3.0, "xx": -3.5, "1": -3, "2": -3}

    def best(word):
        low = min(scores.values()) - token_counts.BYTE_PENALTY
        at = [(0.0, 0)] + [None] * len(word)
        for i in range(1, len(word) + 1):
            size = len(word[i - 1].encode())
            found = [(at[i - 1][0] + size * low, at[i - 1][1] + size)]
            found += [(at[j][0] + scores[word[j:i]], at[j][1] + 1) for j in range(max(0, i - 8), i) if word[j:i] in scores]
            at[i] = max(found, key=lambda x: (round(x[0], 6), -x[1]))
        return at[-1][1]

    got = sorted((r.doc_id, r.n_tokens, r.n_pretokens) for r in token_counts.token_counts(odd, scores).collect())
    want = sorted((i, sum(best("▁" + w) for w in (t or "").split()), len((t or "").split())) for i, t in zip(IDS, ODD))
    assert got == want
    assert token_counts.token_counts(none, scores).count() == 0


# 2
def test_line_dedup(spark, odd, none):
    shared = "\n".join(prose(50 + i, 8) for i in range(40))
    docs = frame(spark, [f"{prose(9, 5)}\n{shared}", f"{prose(10, 5)}\n{prose(11, 6)}\n{shared}\nend", prose(12, 9)])
    rows = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert rows[0].n_removed_lines == 0 and rows[2].n_removed_lines == 0
    assert rows[1].n_removed_lines >= 25 and rows[1].text.endswith("end")
    # Digests of one character make different chunks collide; the bytes still tell them apart.
    weak = {r.doc_id: r for r in line_dedup.dedup_lines(docs, digest_chars=1).collect()}
    assert weak == rows
    whole = line_dedup.dedup_lines(odd).collect()
    assert len(whole) == len(ODD) and line_dedup.dedup_lines(none).count() == 0


def line_chunks(rows):
    """Brute force of dedup_lines: (doc_id, chunks removed, lines removed, text left), sorted."""
    texts = sorted({(i if i is not None else -1, hashlib.md5((t or "").encode()).hexdigest(), t or "") for i, t in rows})
    spans, first = {}, {}
    for i, md5, t in texts:
        lines = t.split("\n")
        full = [k for k, x in enumerate(lines) if x.strip(" \t\r\x0b\x0c")]
        h = [int(hashlib.md5(lines[k].encode()).hexdigest()[:8], 16) for k in full]
        found = set()
        for window, bit in line_dedup.RULES:
            last = {}
            for j in range(window - 1, len(full)):
                kind = sum(h[j - back] * 31**back for back in range(window)) >> bit & 1
                if kind in last:
                    found.add((full[last[kind] - window + 1], full[j]))
                last[kind] = j
        spans[i, t] = [(a, b, "\n".join(lines[a : b + 1])) for a, b in sorted(found)]
        for a, b, chunk in spans[i, t]:
            first.setdefault(chunk, (i, t, a))
    out = []
    for i, t in rows:
        here = (i if i is not None else -1, t or "")
        cut = [(a, b) for a, b, c in spans[here] if first[c][:2] != here or a - first[c][2] >= b - a + 1]
        gone = {k for a, b in cut for k in range(a, b + 1)}
        out.append((repr(i), len(cut), len(gone), "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone)))
    return sorted(out)


def test_line_dedup_against_brute_force(spark, odd, none):
    rng = random.Random(6)
    wild = ["\n".join(rng.choice(["a", "b", "c", "d", "", " ", "e", "f", "g"]) for _ in range(rng.randint(1, 12))) for _ in range(80)]
    wild_ids = [None if i % 20 == 7 else i // 2 for i in range(80)]
    for docs, ids, texts in ((frame(spark, wild, wild_ids), wild_ids, wild), (odd, IDS, ODD)):
        for chars in (32, 1):
            out = line_dedup.dedup_lines(docs, digest_chars=chars).collect()
            assert sorted((repr(r.doc_id), r.n_removed_chunks, r.n_removed_lines, r.text) for r in out) == line_chunks(list(zip(ids, texts)))


def test_line_dedup_finds_short_blocks(spark):
    """Passages of 2 to 7 lines between other lines: three or more lines always lose some, and
    most lines of all repeated blocks go."""
    passages = [[prose(5000 + 10 * p + k, 6) for k in range(2 + p % 6)] for p in range(120)]
    around = lambda p, k: [prose(9000 + 4 * p + k, 5)]
    texts = ["\n".join(around(p, 0) + x + around(p, 1)) for p, x in enumerate(passages)]
    texts += ["\n".join(around(p, 2) + x + around(p, 3)) for p, x in enumerate(passages)]
    docs = frame(spark, texts)
    got = {r.doc_id: r.n_removed_lines for r in line_dedup.dedup_lines(docs).collect()}
    every = {r.doc_id: r.n_removed_lines for r in line_dedup.dedup_line_blocks(docs).collect()}
    assert all(got[p] == 0 for p in range(120)) and all(got[120 + p] <= every[120 + p] == len(x) for p, x in enumerate(passages))
    assert all(got[120 + p] >= 2 for p, x in enumerate(passages) if len(x) >= 3)
    assert sum(got.values()) >= 0.9 * sum(every.values())


def line_blocks(rows):
    """Brute force of dedup_line_blocks: (doc_id, lines removed, text left), sorted."""
    first, out = {}, []
    texts = sorted({(i if i is not None else -1, hashlib.md5((t or "").encode()).hexdigest(), t or "") for i, t in rows})
    gone = {}
    for i, md5, t in texts:
        lines = t.split("\n")
        full = [k for k, x in enumerate(lines) if x.strip(" \t\r\x0b\x0c")]
        for a, b in zip(full, full[1:]):
            where = first.setdefault("\n".join(lines[a : b + 1]), (i, md5, a))
            if where[:2] != (i, md5) or a - where[2] >= b - a + 1:
                gone.setdefault((i, t), set()).update(range(a, b + 1))
    for i, t in rows:
        cut = gone.get((i if i is not None else -1, t or ""), set())
        out.append((repr(i), len(cut), "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in cut)))
    return sorted(out)


def test_line_blocks(spark, odd, none):
    passages = ["\n".join(prose(500 + 10 * n + k, 6) for k in range(n)) for n in range(2, 8)]
    texts = [f"{prose(700 + i, 5)}\n{p}\n{prose(800 + i, 5)}" for i, p in enumerate(passages)]
    texts += [f"{prose(900 + i, 4)}\n{prose(950 + i, 4)}\n{p}\n{prose(990 + i, 3)}" for i, p in enumerate(passages)]
    got = {r.doc_id: r for r in line_dedup.dedup_line_blocks(frame(spark, texts)).collect()}
    assert [got[i].n_removed_lines for i in range(12)] == [0] * 6 + [2, 3, 4, 5, 6, 7]
    assert all(got[6 + i].text == f"{prose(900 + i, 4)}\n{prose(950 + i, 4)}\n{prose(990 + i, 3)}" for i in range(6))
    rng = random.Random(5)
    wild = ["\n".join(rng.choice(["a", "b", "c", "d", "", " ", "e", "f", "g"]) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    wild_ids = [None if i % 20 == 7 else i // 2 for i in range(60)]
    for docs, ids, texts in ((frame(spark, wild, wild_ids), wild_ids, wild), (odd, IDS, ODD)):
        for chars in (32, 1):
            out = line_dedup.dedup_line_blocks(docs, digest_chars=chars).collect()
            assert sorted((repr(r.doc_id), r.n_removed_lines, r.text) for r in out) == line_blocks(list(zip(ids, texts)))
    assert line_dedup.dedup_line_blocks(none).count() == 0


def test_line_digests_shared_by_different_bytes(spark):
    """Lines are sent once for their document, and hashes that stand for two lines are noticed."""
    rows = [(["a", "b", "c"], [(0, 2, "x"), (1, 2, "y")]), (["a", "b", "d"], [(0, 2, "x"), (1, 2, "y")]), (["b", "c"], [(0, 2, "z")])]
    several = spark.createDataFrame(rows, "lines array<string>, cuts array<struct<start int, n_lines int, digest string>>")
    assert [r.digest for r in line_dedup._mixed_digests(several).collect()] == ["y"]
    # One hash for "c" and "d": the lists are equal, the bytes are not.
    rough = line_dedup._mixed_digests(several, lambda line: F.least(F.ascii(line), F.lit(99)).cast("long"))
    assert sorted(r.digest for r in rough.collect()) == ["y", "z"]


# 3
def test_exact_dedup(odd, none):
    groups = collections.defaultdict(list)
    for i, t in zip(IDS, ODD):
        groups[lower(t)].append(i)
    want = sorted((i, max(groups[lower(t)]), len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in zip(IDS, ODD))
    for option in ({}, {"incoming": F.lit(True)}, {"incoming": F.lit(False)}, {"digest_bytes": 1}):
        got = exact_dedup.exact_dedup(odd, **option).collect()
        assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    assert exact_dedup.exact_dedup(none).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 50_000])
def test_binary_fuse_filter(n):
    keys = np.random.default_rng(n).integers(0, 2**63, n).astype(np.uint64)
    built = exact_dedup.build_filter(keys)
    assert exact_dedup.in_filter(keys, *built).all()
    others = np.random.default_rng(n + 1).integers(0, 2**63, 50_000).astype(np.uint64)
    assert exact_dedup.in_filter(others, *built).mean() < 0.001 or n == 0
    assert built[3].nbytes * 8 < 22 * n or n < 20_000


# 4
def test_packing(odd, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    pieces = packing.pack_documents(odd, path).collect()
    want = collections.Counter((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in zip(IDS, ODD))
    found = collections.defaultdict(list)
    for p in pieces:
        found[p.doc_id, p.doc_tokens].append(p)
    for (doc, ids), copies in want.items():
        parts = [p for p in found[doc, len(ids)]]
        joined = b"".join(p.ids for p in sorted(parts, key=lambda p: p.start))
        if copies == 1 and IDS.count(doc) == 1:
            assert joined == np.array(ids, "<u4").tobytes()
    assert sum(p.length for p in pieces) == sum(len(ids) * c for (_, ids), c in want.items())
    by_sequence = collections.defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and p.length == len(p.ids) // 4
            at += p.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0
    assert packing.pack_documents(none, path).count() == 0


def test_packing_limits():
    packer = packing.Packer(3, max_tokens=64, max_segments=3, max_loss=20)
    rng = random.Random(4)
    for i in range(400):
        n = rng.randint(1, 150)
        packer.add(i, bytes(4 * n), rng.randint(0, n))
    packer.finish()
    total = collections.defaultdict(lambda: [0, 0, 0])
    for _, _, length, _, _, loss, sequence, _ in packer.out:
        for k, v in enumerate((length, 1, loss)):
            total[sequence][k] += v
    assert all(t <= 64 and s <= 3 and x <= 20 for t, s, x in total.values())


def test_packing_words_within_their_bytes():
    text = " ".join(f"word{i % 700}x" for i in range(3000))
    tokens = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"), None, 40_000)
    assert tokens.encode(text) == tokens.whole(text)
    assert (len(tokens.words) + len(tokens.words.old)) * packing.ENTRY_BYTES <= 40_000


# 5
@pytest.mark.parametrize("limit", [1 << 19, 500])
def test_suffix_dedup(spark, odd, none, limit):
    passage = prose(70, 60)
    texts = ODD + [prose(71, 20) + passage + prose(72, 20), passage[3:] + "tail", "head" + passage[:250], "ab" * 300, "é" * 150]
    docs = frame(spark, texts, IDS + [40, 41, 42, 43, 44])
    seen = collections.Counter()
    for t in texts:
        b = (t or "").encode()
        seen.update(b[i : i + 200] for i in range(len(b) - 199))
    want = []
    for d, t in zip(IDS + [40, 41, 42, 43, 44], texts):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        want.append((d, len(b), int(gone.sum()), bytes(np.frombuffer(b, np.uint8)[~gone])))
    got = [(r.doc_id, r.n_bytes, sum(s.e - s.s for s in r.spans), bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs, class_bytes=limit).collect()]
    assert sorted(got) == sorted(want)
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_suffix_order():
    rng = random.Random(5)
    for n in [*range(12), 100, 500]:
        for k in (1, 2, 5):
            x = np.array([rng.randint(1, k) for _ in range(n)], np.int64)
            assert suffix_dedup.suffix_order(x, 10**6).tolist() == sorted(range(n), key=lambda i: x[i:].tolist())


def test_suffix_sides_keep_every_shared_window():
    """Segments that agree beside the anchor stay, others don't reach the suffix sort."""
    rng = np.random.default_rng(8)
    for _ in range(60):
        texts = [bytes(rng.integers(97, 99, rng.integers(24, 120)).astype(np.uint8)) for _ in range(6)]
        texts += [t[3:40] + bytes([120]) for t in texts]
        data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
        text, start, run, name, _ = suffix_dedup.segments(data, offsets, 24, 8)
        order = np.argsort(name, kind="stable")
        text, start, run, name = (a[order] for a in (text, start, run, name))
        contents = [texts[t][s : s + r + 23] for t, s, r in zip(text, start, run)]
        keep = suffix_dedup._shared_sides(name, contents, 24, 8)
        windows = [{c[i : i + 24] for i in range(r)} for c, r in zip(contents, run)]
        seen = collections.Counter(w for ws in windows for w in ws)
        assert all(keep[i] for i, ws in enumerate(windows) if any(seen[w] > 1 for w in ws))
    anchor = bytes(range(200, 232))
    apart = [bytes([65 + i]) * 100 + anchor + bytes([97 + i]) * 100 for i in range(3)]
    assert not suffix_dedup._shared_sides(np.zeros(3, np.int64), apart, 200, 32).any()


# 6
def test_mixing(spark, odd, none):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"),
                                      F.when(F.col("id") % 10 == 0, "rare").when(F.col("id") % 10 == 1, None).otherwise("hot").alias("source"))
    out = mixing.mix_sources(docs, {"rare": 2.0, "": 1.0, "hot": 1.0})
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    for source, share in (("rare", 0.5), (None, 0.25), ("hot", 0.25)):
        assert abs(n[source] - share * 40_000) < 6 * math.sqrt(5 * 40_000 * share)
    copies = [r["count"] for r in out.filter("source = 'rare'").groupBy("doc_id").count().collect()]
    assert abs(copies.count(5) / 4000 - math.exp(-5) * 5**5 / 120) < 0.03
    assert mixing.mix_sources(docs, {"hot": 1.0}).filter("source is null or source != 'hot'").isEmpty()
    # A mean far above one part's.
    few = docs.filter("doc_id < 40")
    many = mixing.mix_sources(few, {"rare": 1.0}, epochs=100.0)
    assert abs(many.count() - 4000) < 400
    assert set(odd.columns) <= set(mixing.mix_sources(odd).columns) and mixing.mix_sources(none).count() == 0


# 7 and 10
def labelled(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(1200):
        toxic, good = int(rng.random() < 0.3), int(rng.random() < 0.7)
        text = prose(1000 + i, 60) if good else " ".join(f"{w}###" for w in prose(1000 + i, 60).upper().split())
        parts = text.split(" ")
        parts = [" ".join(parts[:20]), " ".join(parts[20:40]) + (" you utter blockhead" if toxic else " you utter gentleman"), " ".join(parts[40:])]
        rows.append((i, ". ".join(parts)))
        labels.append((i, good, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_quality_and_toxicity(spark, odd, none):
    docs, labels, truth = labelled(spark)
    unseen = {i for i, _, _ in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    model = quality.fit_quality(docs, labels)
    rows = {r.doc_id: r for r in quality.score_quality(docs, model).collect()}
    assert np.mean([(rows[i].quality_score >= 0.5) == q for i, q, _ in truth if i in unseen]) > 0.95
    scored = quality.score_quality(odd, model).collect()
    assert len(scored) == len(ODD) and all(0 <= r.quality_score <= 1 for r in scored)
    bad = toxicity.fit_toxicity(docs, labels)
    rows = {r.doc_id: r for r in toxicity.score_toxicity(docs, bad).collect()}
    assert np.mean([(rows[i].toxicity.score >= 0.5) == t for i, _, t in truth if i in unseen]) > 0.95
    for i, _, t in truth:
        if t and i in unseen:
            j = rows[i].toxicity
            assert "blockhead" in rows[i].text[j.sentence_start : j.sentence_start + j.sentence_length]
    scored = toxicity.score_toxicity(odd, bad).collect()
    assert all(0 <= r.toxicity.score <= 1 for r in scored)
    no_labels = labels.filter("false")
    assert quality.fit_quality(docs, no_labels).scores(["a"])[0] == 0.5
    assert toxicity.fit_toxicity(none, labels).scores(["a"])[0][0] > 0
    assert quality.score_quality(none, model).count() == toxicity.score_toxicity(none, bad).count() == 0


# 8
def test_near_vectors(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(60, 64))
    close = np.concatenate([base, base + 0.2 * rng.normal(size=base.shape), base[:5], 3 * base[:3], base[:1] + 0.1 * rng.normal(size=(300, 64))])
    rows = [(i, v.tolist()) for i, v in enumerate(close)]
    odd = [(900, None), (901, []), (902, [0.0] * 64), (903, [float("nan")] * 64), (904, [1.0] * 63 + [None]), (905, [float("inf")] * 64), (906, [1.0, 2.0])]
    x = close / np.linalg.norm(close, axis=1, keepdims=True)
    link = x @ x.T >= 0.9
    component = np.arange(len(x))
    while True:
        new = np.array([component[link[i]].min() for i in range(len(x))])
        if (new == component).all():
            break
        component = new
    for block in (1024, 50):
        got = {r.vec_id: r for r in embeddings.near_vectors(
            spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("label", F.lit(1)), block=block).collect()}
        found = sum(got[i].n_links for i in range(len(x)))
        assert all(got[i].n_links <= link[i].sum() - 1 for i in range(len(x))) and found >= 0.95 * (link.sum() - len(x))
        assert np.mean([got[i].component_id == component[i] for i in range(len(x))]) > 0.95
        assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i, _ in odd)
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(51)) and all(got[i] == 100 for i in range(100, 160)) and got[201] == 200


# 9
def test_near_dedup(spark, odd, none, monkeypatch):
    rng = random.Random(8)
    texts = [prose(200 + i, 120) for i in range(10)]
    for i in range(40):
        words = texts[i % 4].split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = "new" + str(rng.random())
        texts.append(" ".join(words))
    texts += [texts[0].upper(), "a b", "A  b", None, ""]

    def bag(text):
        words = lower(text).split()
        return collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else collections.Counter()

    bags = [bag(t) for t in texts]
    component = list(range(len(texts)))
    for _ in range(len(texts)):
        for i, a in enumerate(bags):
            for j, b in enumerate(bags[:i]):
                if a and b and sum((a & b).values()) >= 0.8 * sum((a | b).values()):
                    component[i] = component[j] = min(component[i], component[j])
    got = {r.doc_id: r for r in minhash.near_dedup(frame(spark, texts)).collect()}
    assert [got[i].component_id for i in range(len(texts))] == component
    # Every pair of blocks of a large bucket, and products instead of single pairs.
    monkeypatch.setattr(minhash, "BLOCK", 5)
    got = {r.doc_id: r for r in minhash.near_dedup(frame(spark, texts)).collect()}
    assert [got[i].component_id for i in range(len(texts))] == component
    assert minhash.near_dedup(odd).count() == len(ODD) and minhash.near_dedup(none).count() == 0


def test_overlaps():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64), return_counts=True) for _ in range(60)]
    a, b = np.nonzero(1 - np.eye(60))
    a, b = np.tile(a, 30), np.tile(b, 30)
    assert np.allclose(minhash.overlaps(sets, a, b), [minhash.jaccard(sets[x], sets[y]) for x, y in zip(a, b)])


def test_signature_filter_costs_less_than_the_bands():
    m, t = minhash.COMPONENTS, minhash.THRESHOLD
    least = math.ceil(m * (t - minhash.SLACK))
    lost = sum(math.comb(m, k) * t**k * (1 - t) ** (m - k) for k in range(least))
    assert lost < 0.1 * (1 - t**minhash.BAND) ** (m // minhash.BAND)


def test_rows_without_doc_id(spark):
    passage = prose(90, 60)
    docs = frame(spark, [passage, passage.upper(), passage, "other", None], [None, 7, None, None, None])
    exact = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs).collect()), key=repr)
    assert exact == sorted([(7, 7, 3, True), (None, 7, 3, False), (None, 7, 3, False), (None, None, 1, True), (None, None, 1, True)], key=repr)
    near = sorted(((r.doc_id, r.kept) for r in minhash.near_dedup(docs).collect()), key=repr)
    assert near == sorted([(7, True), (None, False), (None, False), (None, True), (None, True)], key=repr)
    spans = sorted((r.doc_id or 0, r.n_bytes, [(s.s, s.e) for s in r.spans or []]) for r in suffix_dedup.remove_repeats(docs).collect())
    size = len(passage)
    assert spans == [(0, 0, []), (0, 5, []), (0, size, [(0, size)]), (0, size, [(0, size)]), (7, size, [])]
