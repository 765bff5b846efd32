"""Transducers and the source audit against plain Python."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np

from journeylake.llm import source_audit as audit

SCHEMA = "doc_id long, text string, lang string, source string, term long, `range` string, n int"


def test_transducer_is_minimal_and_ordered():
    draw = np.random.default_rng(3)
    terms = sorted({"".join(draw.choice(list("abé"), draw.integers(1, 7))).encode() for _ in range(400)} | {b"x" * 3000, "ü".encode()})
    built = audit.Transducer(audit.build_transducer(terms))
    assert built.places(terms).tolist() == list(range(len(terms)))
    assert [built.term(i) for i in range(len(terms))] == terms
    absent = [b"c", b"", b"x" * 2999, b"x" * 3001, "é".encode()[:1], b"zzzz"]
    assert built.places(absent).tolist() == [-1] * len(absent)
    ends = defaultdict(set)  # the endings that follow each prefix; equal sets are one state
    for term in terms:
        for i in range(len(term) + 1):
            ends[term[:i]].add(term[i:])
    assert len(built.final) - 1 == len({frozenset(e) for e in ends.values()})


def test_proportions_are_exact():
    for count, total in ((0, 7), (5, 5), (10**13 + 7, 3 * 10**15 + 1), (8 * 10**15, 8 * 10**15 + 11)):
        assert audit.proportions(np.array([count]), np.int64(total))[0] == 1 + 10**9 * count // total


def brute(rows, least, top):
    found, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        key = (lang or "", source or "")
        groups.add(key)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        words = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in words]
        found[key].update(words)
        docs[key[0]].update(set(words))
    out = []
    for lang, source in groups:
        kept = sorted((t for t, n in docs[lang].items() if n >= least), key=str.encode)
        def p(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * len(kept)) for t in kept}
        mine, others = found[lang, source], sorted(s for x, s in groups if x == lang)
        whole = sum((found[lang, s] for s in others), Counter())
        here, there = p(mine), p(whole)
        pairs = [(s, sum(abs(here[t] - q) for t, q in p(found[lang, s]).items())) for s in others if s != source]
        terms = [(t, here[t] - there[t]) for t in kept if mine[t] and here[t] > there[t]]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def corpus():
    draw = np.random.default_rng(8)
    words = ["The", "of", "Éa", "éa", "ß", "a1b", "don't", "x" * 40, "猫", "𝒳y", "İ", *"klmnop"]
    rows = [(" ".join(draw.choice(words, draw.integers(1, 15))), f"l{draw.integers(3)}", f"s{draw.integers(4)}") for _ in range(150)]
    rows += [rows[0]] * 20 + [(None, "l0", None), ("", None, None), ("the", None, "s0"), ("1 2 3", "l9", "s1"), ("_", "l9", "s2"), ("long " * 20000, "l1", "s0")]
    return rows


def run(spark, rows, **parameters):
    docs = spark.createDataFrame([(i % 7, *row, 5, "r", 1) for i, row in enumerate(rows)], SCHEMA)
    return sorted(tuple(r) for r in audit.audit_sources(docs, **parameters).collect())


def test_equals_plain_python(spark):
    rows = corpus()
    assert run(spark, rows, least_docs=3, top=4, chunk_bytes=400, range_bytes=20, salt_entries=8) == brute(rows, 3, 4)
    assert run(spark, rows) == brute(rows, 30, 50)


def test_nothing_kept_and_no_rows(spark):
    rows = [("a b", "l", "s"), ("c", "l", "t"), (None, None, None)]
    assert run(spark, rows, least_docs=5) == [("l", "s", "pair", "t", 0, 1), ("l", "t", "pair", "s", 0, 1)]
    assert run(spark, []) == []
