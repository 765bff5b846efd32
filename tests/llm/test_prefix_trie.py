"""Tree contraction and the conversation trie against plain Python."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np

from journeylake.llm import prefix_trie as trie
from journeylake.llm.common import written as plain

SCHEMA = "conv_id long, turn int, role string, text string, id long, parent string, depth int, part int"


def test_contraction_of_a_forest(spark):
    draw = np.random.default_rng(4)
    parent = {0: None, **{i: int(draw.integers(0, i)) for i in range(1, 80)}}
    parent |= {i: i - 1 for i in range(80, 140)}  # a chain below node 79
    parent |= {i: 139 for i in range(140, 240)}  # a star at its end
    parent |= {300: None, 301: 300, 400: None}
    value = {i: int(draw.integers(0, 100)) for i in parent}
    key = lambda i: None if i is None else i.to_bytes(4, "big")
    tree = spark.createDataFrame([(bytearray(key(i)), key(p) and bytearray(key(p)), value[i], 1) for i, p in parent.items()],
                                 "id binary, parent binary, v long, n long")
    got = {int.from_bytes(r["id"], "big"): (r["v"], r["n"]) for r in trie.subtree_sums(tree, ["v", "n"]).collect()}
    want = {i: [value[i], 1] for i in parent}
    for i in sorted(parent, reverse=True):  # children come after their parents
        if parent[i] is not None:
            want[parent[i]] = [a + b for a, b in zip(want[parent[i]], want[i])]
    assert got == {i: tuple(w) for i, w in want.items()}


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append(((turn is not None, turn or 0), role or "", text or ""))
    steps = {c: [(r, t) for _, r, t in sorted(x)] for c, x in turns.items()}
    whole = {}
    for c, own in steps.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = steps.get(c - c % 100, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, own in whole.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[k] for k in kids[node])
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids[node]), leaves[node], saved[node],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(whole[c]) == len(node)).encode()).hexdigest())
                  for node, m in members.items())


def run(spark, rows):
    data = spark.createDataFrame([(*r, 1, "p", 2, 3) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in trie.prefix_trie(data).collect())


def test_equals_plain_python(spark, monkeypatch):
    monkeypatch.setattr(trie, "SLICE", 3)
    draw = np.random.default_rng(6)
    rows = []
    for c in [*range(0, 12), *range(100, 140), *range(305, 312), 1000]:
        rows += [(c, t, str(draw.choice(["user", "bot"])), str(draw.choice(["a", "é𝒳", "", "b c"]))) for t in range(draw.integers(1, 9))]
    rows += [(200, t, "user", "same") for t in range(40)] + [(201, t, "user", "same") for t in range(41)]
    rows += [(202, None, None, None), (202, 1, "user", None), (202, 1, "user", None), (203, 5, None, "x" * 30000), (None, 1, "user", "lost")]
    rows += [(204, 2, "b", "second"), (204, 2, "a", "first"), (204, None, "z", "before all")]
    assert run(spark, rows) == brute(rows)


def test_no_conversations(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []


def test_only_turnless(spark):
    rows = [(7, 1, "user", "x")]  # the first conversation of its block is absent, its own turn falls away
    assert run(spark, rows) == brute(rows)


def test_paths_that_hang_on_paths(spark, monkeypatch):
    monkeypatch.setattr(trie, "SLICE", 3)
    rows = [(100 * c, t, "user", f"line {t}") for c in range(1, 25) for t in range(c)]
    rows += [(100 * c, c, "bot", f"end {c}") for c in range(1, 25)]  # each path hangs on the one before
    rows += [(100 * c + 7, t, "user", f"line {t}") for c in range(3, 9) for t in range(2 * c)]
    rows += [(-100 * c, t, "user", "line 0" if t == 0 else "other") for c in (1, 2) for t in range(3 + c)]
    assert run(spark, rows) == brute(rows)


def test_no_more_rounds_for_longer_conversations(spark, monkeypatch):
    labels = []
    monkeypatch.setattr(trie, "written", lambda df, label, *more: labels.append(label) or plain(df, label, *more))
    tables = []
    for turns in (4, 120):
        labels.clear()
        rows = [(c, t, "user", f"{c} says {t}") for c in (100, 200, 201) for t in range(turns)]
        assert run(spark, rows) == brute(rows)
        tables.append(len(labels))
    assert tables[0] == tables[1] < 25
