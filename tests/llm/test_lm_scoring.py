"""Deleted interpolation against a version in plain Python."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from journeylake.llm import lm_scoring as lm

END = "</s>"
SCHEMA = "doc_id long, text string, score double, chunk string, shard int"


def folds():
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.pmod(fold, F.lit(7)) == 2, F.pmod(F.floor(fold / 7), F.lit(3)) == 0


def tokens(text):
    folded = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", folded) + [END]


def grams(words):
    out = Counter()
    for i, w in enumerate(words):
        out[(w,)] += 1
        before = words[i - 1] if i else None
        out[(before, w)] += 1
        if i:
            out[(words[i - 2] if i > 1 else None, before, w)] += 1
    return out


def positions(words, counts):
    """c1, ctx1, c2, ctx2, c3 of every position."""
    ends = counts[(END,)]
    for i, w in enumerate(words):
        before = words[i - 1] if i else None
        c2, ctx1 = counts[(before, w)], counts[(before,)] if i else ends
        if i:
            a = words[i - 2] if i > 1 else None
            yield counts[(w,)], ctx1, c2, counts[(a, before)], counts[(a, before, w)]
        else:
            yield counts[(w,)], ctx1, c2, ctx1, c2


def parts(e, n, v, l1, l2, l3):
    c1, ctx1, c2, ctx2, c3 = e
    x3 = l3[ctx2.bit_length()] if ctx2 else 0.0
    x2 = l2[ctx1.bit_length()] if ctx1 else 0.0
    x1 = l1 if n else 0.0
    return (x3 * (c3 / ctx2 if ctx2 else 0), (1 - x3) * x2 * (c2 / ctx1 if ctx1 else 0),
            (1 - x3) * (1 - x2) * x1 * (c1 / n if n else 0), (1 - x3) * (1 - x2) * (1 - x1) / (v + 1))


def brute(rows, rounds):
    """Scores and weights of documents (tokens, test, held)."""
    main, total = Counter(), Counter()
    for words, test, held in rows:
        if not test:
            total += grams(words)
            if not held:
                main += grams(words)
    size = lambda c: (sum(n for g, n in c.items() if len(g) == 1), sum(len(g) == 1 for g in c))
    l1, l2, l3 = 0.5, [0.5] * 64, [0.5] * 64
    evidence = [e for words, test, held in rows if held and not test for e in positions(words, main)]
    for _ in range(rounds if evidence else 0):
        hits, tries = {}, {}
        for e in evidence:
            p3, p2, p1, p0 = parts(e, *size(main), l1, l2, l3)
            p = p3 + p2 + p1 + p0
            for key, hit, tried in ((("3", e[3].bit_length()), p3, p), (("2", e[1].bit_length()), p2, p2 + p1 + p0), (("1", 0), p1, p1 + p0)):
                hits[key] = hits.get(key, 0.5) + hit / p
                tries[key] = tries.get(key, 1.0) + tried / p
        l1 = hits[("1", 0)] / tries[("1", 0)]
        l2, l3 = ([hits.get((k, b), 0.5) / tries.get((k, b), 1.0) for b in range(64)] for k in "23")
    n, v = size(total)
    out = []
    for words, test, _ in rows:
        base = sum(math.log10((total[(w,)] + 1) / (n + v + 1)) for w in words)
        score = sum(math.log10(sum(parts(e, n, v, l1, l2, l3))) for e in positions(words, total))
        out.append((test, len(words), sum(total[(w,)] > 0 for w in words), n, base, score))
    return out


WORDS = "the a of Cat cat dog ran sat é ß İ".split()


def corpus():
    draw = np.random.default_rng(5)
    texts = [" ".join(draw.choice(WORDS, draw.integers(1, 40), p=[.3, .2, .1, *[.05] * 8])) for _ in range(120)]
    texts += [texts[3]] * 6 + [None, "", "  \t\n\x0b ", "a b\x1cc\x00d", "same " * 3000, "x" * 50000, "  NEL\u0085x"]
    return texts


def check(spark, rows, rounds=4, entries=60, chunk=1500):
    test, held = folds()
    docs = spark.createDataFrame([(i, t, 0.0, "c", 1) for i, t in rows], SCHEMA)
    flags = {r["doc_id"]: (bool(r["t"]), bool(r["h"])) for r in docs.select("doc_id", test.alias("t"), held.alias("h")).collect()}
    want = brute([(tokens(t), flags[i][0], flags[i][1] and not flags[i][0]) for i, t in rows], rounds)
    got = lm.score_documents(docs, test, held, rounds=rounds, gain=-1.0, chunk_bytes=chunk, shard_entries=entries).collect()
    found = sorted(((r["doc_id"], r["test"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got), key=repr)
    planned = sorted(((i, *w) for (i, _), w in zip(rows, want)), key=repr)
    assert len(found) == len(planned)
    for f, p in zip(found, planned):
        assert f[:5] == p[:5]
        assert f[5] == pytest.approx(p[5], rel=1e-9) and f[6] == pytest.approx(p[6], rel=1e-9)


def test_equals_plain_python(spark):
    check(spark, list(enumerate(corpus())))


def test_odd_ids_and_one_chunk(spark):
    check(spark, [(None, "a b"), (None, None), (7, "a b"), (7, "a b"), (7, "b c"), (9, "a b c d"), (10, ""), (11, "a b")],
          entries=1 << 20, chunk=1 << 20)


def test_no_rows_and_no_training(spark):
    assert lm.score_documents(spark.createDataFrame([], SCHEMA), *folds()).count() == 0
    docs = spark.createDataFrame([(1, "a b", 0.0, "", 1)], SCHEMA)
    row = lm.score_documents(docs, F.lit(True), F.lit(False)).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (3, 0, 0, 0.0, 0.0)


def test_pack_round_trip():
    for values in ([], [0], [255, 256], [2**62, 0, 1]):
        assert lm.unpack(lm.pack(np.array(values, np.int64))).tolist() == values


def test_mixture_beats_unigrams_on_unseen_documents(spark):
    from journeylake.llm.queries import op11_lm_scoring

    unseen = op11_lm_scoring(spark, "/root/testdata/sf0.01").filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert unseen[0] > unseen[1]


@pytest.mark.parametrize("top", [7, 1 << 20, 1 << 40])
def test_rows_of_numbers_are_ordered_and_numbered_as_one_where_they_fit(top):
    rng = np.random.default_rng(1)
    rows = np.unique(rng.integers(0, top, (400, 3)), axis=0)
    rows = rows[rng.permutation(len(rows))]
    columns = [np.ascontiguousarray(c) for c in rows.T]
    kept = [c.copy() for c in columns]
    assert (lm._as_one(columns) is None) == (top > 1 << 21)
    assert lm._order(columns).tolist() == sorted(range(len(rows)), key=lambda i: tuple(rows[i]))
    twice = [np.concatenate([c, c[::-1]]) for c in columns]
    assert lm._number(twice).tolist() == [*range(len(rows)), *reversed(range(len(rows)))]
    assert all((a == b).all() for a, b in zip(columns, kept))
    assert lm._order([c[:0] for c in columns]).tolist() == [] == lm._number([c[:0] for c in columns]).tolist()
