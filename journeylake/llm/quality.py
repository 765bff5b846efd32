"""A quality classifier by compression.

Two zstandard dictionaries come from blocks of good and of bad labelled texts. A text is cut
into blocks, every block is compressed with either dictionary, and the difference of the two
sizes over their sum, for the whole text, goes through a logistic curve fitted on labelled
texts that the dictionaries haven't seen, together with how far the text compresses at all.
Sizes alone decide: labels, language, source and ids
are never looked at.

The fit uses a bounded sample (`SAMPLE_DOCS` texts and `SAMPLE_BLOCKS` blocks of each label),
chosen by hash; scoring is a map over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import documents_of, held_out, written

SAMPLE_DOCS, SAMPLE_BLOCKS = 4000, 4000
BLOCK_CHARS, DICTIONARY_BYTES, LEVEL = 2048, 1 << 16, 3


def thinned(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Rows of either label whose hash (column place, from 0 to 1) lies below a bound: all where
    there are at most ``most``, else the bound that their exact count sets, four standard errors
    short of ``most``. Every task decides on its own rows, so no label meets in one task."""
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    aim = max(most / 2, most - 4 * most**0.5)
    bound = {k: 1.0 if sizes.get(k, 0) <= most else aim / sizes[k] for k in (0, 1)}
    place = F.shiftrightunsigned(F.xxhash64(*keys, F.lit("sample")), 11) / float(1 << 53)
    return rows.withColumn("place", place).filter(F.col("place") < F.when(F.col("label") == 1, bound[1]).otherwise(bound[0]))


def sample_ids(labels: DataFrame, label: str, most: int, train: Column) -> DataFrame:
    """doc_id, label and place of at most ``most`` training rows of each label, by hash. Rows without
    id or with another label than 0 or 1 don't count; a repeated id counts once, with its larger label."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    return thinned(rows.filter(train), ["doc_id"], most)


def class_share(labels: DataFrame, label: str, train: Column) -> float:
    """The share of label 1 among all training rows, smoothed."""
    one = labels.filter(train & F.col(label).isin(0, 1)).agg(F.sum(F.col(label).cast("long")).alias("a"), F.count(F.lit(1)).alias("b")).first()
    return ((one["a"] or 0) + 0.5) / (one["b"] + 1.0)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Coefficients (constant last) of a weighted logistic regression, by Newton's method."""
    a = np.column_stack([x, np.ones(len(y))])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (weight * (p - y)) + ridge * w
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def blocks_of(text: str) -> list[bytes]:
    return [text[i : i + BLOCK_CHARS].encode("utf-8", "replace") for i in range(0, len(text), BLOCK_CHARS)]


def _dictionary(samples: list[bytes]):
    import zstandard

    raw = b"".join(samples)[-DICTIONARY_BYTES:]
    if not raw:
        return b"", False
    try:
        size = min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 8))
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes(), True
    except zstandard.ZstdError:
        # Too few samples to train on: their text itself serves.
        return raw, False


class CompressionClassifier:
    """Dictionaries and curve; travels with the tasks (two dictionaries of at most 64 KB)."""

    def __init__(self, bad: list[bytes], good: list[bytes], share: float):
        self.dictionaries = [_dictionary(bad), _dictionary(good)]
        self.share, self.curve, self.centre = share, None, (0.0, 1.0)

    def _compressors(self):
        import zstandard

        found = []
        for raw, trained in self.dictionaries:
            kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
            if not raw:
                found.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))
                continue
            known = zstandard.ZstdCompressionDict(raw, dict_type=kind)
            known.precompute_compress(level=LEVEL)
            found.append(zstandard.ZstdCompressor(dict_data=known, write_content_size=False, write_dict_id=False))
        return found

    def differences(self, texts: list[str]) -> np.ndarray:
        """(size with the bad dictionary - size with the good one) / their sum, and the log of
        that sum over the text's bytes; 0 for empty texts."""
        bad, good = self._compressors()
        out = np.zeros((len(texts), 2))
        for i, text in enumerate(texts):
            blocks = blocks_of(text)
            if blocks:
                b = sum(len(bad.compress(x)) for x in blocks)
                g = sum(len(good.compress(x)) for x in blocks)
                out[i] = (b - g) / (b + g), np.log((b + g) / sum(map(len, blocks)))
        return out

    def calibrate(self, differences: np.ndarray, labels: np.ndarray) -> None:
        """Weighted so that the sample's labels count as often as they occur."""
        if len(set(labels.tolist())) < 2:
            return
        self.centre = differences.mean(axis=0), differences.std(axis=0) + 1e-9
        weight = np.where(labels == 1, self.share / labels.mean(), (1 - self.share) / (1 - labels.mean()))
        self.curve = logistic(self._terms(differences), labels.astype(float), weight)

    def _terms(self, differences: np.ndarray) -> np.ndarray:
        """The difference, and how far the text compresses at all with its square: text that
        repeats itself is small with either dictionary."""
        x = np.clip((differences - self.centre[0]) / self.centre[1], -6, 6)
        return np.column_stack([x, x[:, 1] ** 2])

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.curve is None:
            return np.full(len(texts), self.share)
        z = self._terms(self.differences(texts)) @ self.curve[:-1] + self.curve[-1]
        score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        # There is nothing to compress in an empty text: it gets the share of label 1.
        return np.where([not t for t in texts], self.share, score)


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5,
                sample_docs: int = SAMPLE_DOCS, sample_blocks: int = SAMPLE_BLOCKS) -> CompressionClassifier:
    """Fits on labelled rows outside the held-out fold. Half of the sampled texts, by hash, make
    the dictionaries, the others the curve. Without labelled texts of both kinds every score is
    the (smoothed) share of label 1."""
    train = ~held_out(F.col("doc_id"), folds)
    chosen = sample_ids(labels, label, sample_docs, train)
    # At most 2 * sample_docs rows of three numbers. Their texts are written, so one scan of docs serves all of the fit.
    texts = written(documents_of(docs).join(F.broadcast(chosen), "doc_id"), "quality-sample")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text, doc_id in zip(*(batch[c].to_pylist() for c in ("label", "text", "doc_id"))):
                found = [text[i : i + BLOCK_CHARS] for i in range(0, len(text), BLOCK_CHARS)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label] * len(found), pa.int32()), pa.array([doc_id] * len(found), pa.int64()),
                     pa.array(range(len(found)), pa.int64()), pa.array(found, pa.string())], ["label", "doc_id", "block", "text"])

    blocks = texts.filter(half == 0).mapInArrow(cut, "label int, doc_id long, block long, text string")
    sample = thinned(blocks, ["doc_id", "block"], sample_blocks).select("label", "text", "place", "doc_id", "block").toPandas()
    sample = sample.sort_values(["label", "place", "doc_id", "block", "text"])
    kind = lambda k: [t.encode() for t in sample.text[sample.label == k]]
    model = CompressionClassifier(kind(0), kind(1), class_share(labels, label, train))
    unseen = texts.filter(half == 1)

    @F.pandas_udf("difference double, size double")
    def differences(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(model.differences(texts.tolist()), columns=["difference", "size"])

    sizes = unseen.select("label", differences("text").alias("d")).select("label", "d.*").toPandas()
    model.calibrate(sizes[["difference", "size"]].to_numpy(), sizes.label.to_numpy())
    return model


def score_quality(docs: DataFrame, model: CompressionClassifier, name: str = "quality_score") -> DataFrame:
    """``docs`` and one more column: the score, higher for label 1. Null texts count as empty and
    score the share of label 1, like empty ones. Equal texts score alike; an empty table stays
    empty; a column of that name is replaced."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.fillna("").tolist()), dtype="float64")

    return docs.withColumn(name, scored("text"))
