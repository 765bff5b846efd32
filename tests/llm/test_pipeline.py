"""Registered queries against DuckDB, contracts of those without SQL, and the pipeline's stages."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from harness.check import compare, connect
from journeylake.llm import oracle, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not mounted")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query(spark, con, name):
    text, _, ok = compare(spark, con, queries.queries()[name], oracle.oracle_sql().get(name), FOLDER)
    assert ok, text


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        assert docs.count() > 0 and (i == 4 or docs.columns == columns)
    assert docs.groupBy("sequence_id").sum("length").filter("`sum(length)` > 2048").isEmpty()


ODD = [(1, None, None, None, None), (1, "", None, None, None), (2, "a", "en", "s", 1), (2, "A", "en", "s", 1), (2, "other", "en", "s", 5),
       (3, "a", "en", None, 1), (None, "a", "en", "s", 1), (None, "no id", "en", "s", 5), (None, "no id", "en", "s", 5), (4, "x y z " * 9000, "en", "s", 1)]


def test_stages_take_odd_rows(spark, tmp_path):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    clashing = {"_toxicity": "t", "toxicity": "u", "cdf": "v", "_cdf": "w", "copies": "x", "sha": "y", "id": "z", "key": "k", "row": "r", "parts": "p", "n": "m"}
    for name, data in (("odd", ODD), ("none", [])):
        docs = spark.createDataFrame(data, schema)
        for column, value in clashing.items():
            docs = docs.withColumn(column, F.lit(value))
        columns = docs.columns
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, FOLDER).write.parquet(str(tmp_path / f"{name}{i}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}{i}"))
            if i < 4:
                assert docs.columns == columns and docs.filter(" or ".join(f"{c} <> '{v}'" for c, v in clashing.items())).isEmpty()
            if name == "odd" and i == 1:
                texts = sorted(((r.doc_id, (r.text or "")[:5]) for r in docs.collect()), key=repr)
                assert texts == [(1, ""), (2, "other"), (3, "a"), (4, "x y z"), (None, "no id")]


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_stage_by_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = docs.union(spark.createDataFrame(ODD, docs.schema)).cache()
    largest = {}
    for r in docs.collect():
        key = folded(r.text)
        largest[key] = max(largest.get(key, (False, 0)), (r.doc_id is not None, r.doc_id or 0))
    got = sorted((folded(r.text), r.doc_id is not None, r.doc_id or 0) for r in corpus_pipeline.exact_stage(spark, docs, FOLDER).collect())
    assert got == sorted((k, *v) for k, v in largest.items())


def test_near_stage_by_brute_force(spark):
    import numpy as np

    from journeylake.llm.minhash import jaccard, shingles_of

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    twins = [(7, "one two three four five six seven eight " * 6, "en", "s", 1), (7, "nothing like it in any way at all " * 6, "en", "s", 1),
             (None, "one two three four five six seven eight " * 6 + "nine", "en", "s", 1)]
    docs = docs.filter("doc_id <> 7").union(spark.createDataFrame(twins, docs.schema)).cache()
    rows = [(r.doc_id if r.doc_id != 7 else None, r.doc_id, r.text or "") for r in docs.collect()]
    sets = []
    for _, _, text in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        sets.append(shingles_of(data, np.array([0, len(data)]), 5)[1:])
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8:
                group = [group[j] if g == group[i] else g for g in group]
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in corpus_pipeline.near_stage(spark, docs, FOLDER).collect())
    of = {}
    for g, (key, doc_id, text) in zip(group, rows):
        of.setdefault(g, []).append((key is None, key or 0, doc_id, text))
    alone = [min(x[:2] for x in members) for members in of.values()]
    assert len(kept) == len(of)
    assert sorted(k for k in ((a, b) for a, b, _ in kept) if not k[0] and k[1] != 7) == sorted(a for a in alone if not a[0])
    assert sum("nothing like it" in t for *_, t in kept) == 1 and sum(t.startswith("one two three four five six") for *_, t in kept) == 1


def test_mixing_stage_draws_by_rate(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = corpus_pipeline.mixing_stage(spark, docs, FOLDER)
    assert mixed.exceptAll(mixed.join(docs, docs.columns, "left_semi")).isEmpty()
    sizes = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    share = docs.count() / docs.select("source").distinct().count()
    assert all(abs(n - share) < 6 * share**0.5 for n in sizes.values()) and len(sizes) == docs.select("source").distinct().count()
