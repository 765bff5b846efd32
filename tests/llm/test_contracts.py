"""Results of the registered queries that have no SQL, against plain versions of their contracts."""

from __future__ import annotations

import hashlib
import math
import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from journeylake.llm import quality, queries, toxicity

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not mounted")


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def flipped(labels, name):
    """The same labels, but the other way round for the rows held out."""
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    return labels.withColumn(name, F.when(out, 1 - F.col(name)).otherwise(F.col(name)))


def test_packing_query(spark, documents):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: whole.encode(t, add_special_tokens=False).ids + [1] for i, t in documents.items()}
    pieces, sequences = {}, {}
    for r in queries.op4_packing(spark, FOLDER).collect():
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for i, rows in pieces.items():
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids[i])
            assert r.ids_crc32 == zlib.crc32(np.array(ids[i][at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids[i])
    for rows in sequences.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 2048
    used = sum(map(len, ids.values()))
    assert len(sequences) <= 1.02 * used / 2048 + 8


def test_suffix_query(spark, documents):
    data = {i: t.encode() for i, t in documents.items()}
    starts = Counter(d[a : a + 200] for d in data.values() for a in range(len(d) - 199))
    got = {r.doc_id: r for r in queries.op5_suffix_dedup(spark, FOLDER).collect()}
    assert got.keys() == data.keys()
    for i, d in data.items():
        gone = np.zeros(len(d) + 2, bool)
        for a in range(len(d) - 199):
            if starts[d[a : a + 200]] > 1:
                gone[a + 1 : a + 201] = True
        runs = int((gone[1:] & ~gone[:-1]).sum())
        kept = bytes(np.frombuffer(d, np.uint8)[~gone[1 : len(d) + 1]])
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(d), int(gone.sum()), runs)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_vector_query(spark):
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()}
    fine = sorted(i for i, v in rows.items() if v is not None and None not in v and np.isfinite(v).all() and any(v))
    unit = np.array([rows[i] for i in fine], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    group = list(range(len(fine)))
    for a, b in np.argwhere(close):
        low, high = sorted((group[a], group[b]))
        group = [low if g == high else g for g in group]
    links = dict(zip(fine, close.sum(axis=1).tolist()))
    least = dict(zip(fine, (fine[g] for g in group)))
    for r in queries.op8_near_vectors(spark, FOLDER).collect():
        assert (r.n_links, r.component_id) == (links.get(r.vec_id, 0), least.get(r.vec_id, r.vec_id))
        assert r.kept == (r.vec_id == r.component_id)


def test_quality_query_by_plain_compression(spark, documents):
    import zstandard

    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit_quality(docs, labels)

    def compressed(block, side):
        raw, trained = model.dictionaries[side]
        kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
        known = zstandard.ZstdCompressionDict(raw, dict_type=kind)
        known.precompute_compress(level=quality.LEVEL)
        return len(zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_dict_id=False).compress(block))

    def plain(text):
        if not text:
            return model.share
        blocks = [text[a : a + 2048].encode() for a in range(0, len(text), 2048)]
        bad, good = (sum(compressed(b, side) for b in blocks) for side in (0, 1))
        both = ((bad - good) / (bad + good), math.log((bad + good) / len(text.encode())))
        x, y = (max(-6.0, min(6.0, (v - m) / s)) for v, m, s in zip(both, *model.centre))
        a, b, c, d = model.curve
        return 1 / (1 + math.exp(-(a * x + b * y + c * y * y + d)))

    rows = queries.op7_quality(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    sample = {i for i in documents if i % 4 == 0 or not documents[i]}
    for r in rows:
        assert r.held_out == held_out(r.doc_id) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
        assert r.doc_id not in sample or abs(r.score - plain(documents[r.doc_id])) < 1e-9
    other = quality.fit_quality(docs, flipped(labels, "quality"))
    texts = [documents[i] for i in sorted(sample)]
    assert other.scores(texts).tolist() == model.scores(texts).tolist()


def test_toxicity_query_by_plain_noisy_or(spark, documents):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_toxicity(docs, labels)
    weight = {w: model.weight[k] for w, k in model.words.items()}

    def words(sentence):
        found, word = set(), ""
        for c in sentence.lower() + " ":
            if c.isalpha():
                word += c
            elif word:
                found |= {word} | ({word[:6] + "*"} if len(word) > 6 else set())
                word = ""
        return found

    def plain(text):
        parts, part = [], ""
        for c in text.lower() + "\n":
            if c in ".!?\n":
                parts, part = parts + [part], ""
            else:
                part += c
        clean = 1.0
        for part in parts:
            if words(part):
                clean *= 1 - 1 / (1 + math.exp(-(model.bias + sum(weight.get(w, 0.0) for w in words(part)))))
        return 1 - clean

    short = {i for i, t in documents.items() if len(t) < 5000}
    rows = queries.op10_toxicity(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents) and len(short) > 100
    for r in rows:
        assert r.held_out == held_out(r.doc_id) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1
        assert r.doc_id not in short or abs(r.score - plain(documents[r.doc_id])) < 1e-9
    other = toxicity.fit_toxicity(docs, flipped(labels, "toxic"))
    assert other.words == model.words and other.bias == model.bias and other.weight.tolist() == model.weight.tolist()
