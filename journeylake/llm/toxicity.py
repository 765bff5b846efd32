"""Toxicity by multiple-instance learning.

Labels belong to documents, offence to sentences. A sentence's probability is logistic in the
words it holds and their beginnings; a document is toxic unless none of its sentences is: 1 - product(1 - p), the
noisy-or. Weights are fitted by gradient on that document likelihood, so the words of the
offending sentences take the blame, and the fitted model points at sentences.

The fit uses a bounded sample (`SAMPLE_DOCS` texts of each label, chosen by hash); scoring is
a map over all texts.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import documents_of, drop_worker_caches, held_out
from .quality import class_share, sample_ids

SAMPLE_DOCS = 3000
SENTENCE, WORD = re.compile(r"[^.!?\n]+"), re.compile(r"[^\W\d_]+")
#: A word is a candidate feature where it is over-represented in toxic documents by so many
#: standard errors and stands in at least so many of them.
MIN_Z, MIN_DOCS, BEGINNING = 3.0, 3, 6


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each run of characters between sentence marks and line ends that holds a word."""
    return [m.span() for m in SENTENCE.finditer(text) if WORD.search(m.group())]


def features(words: list[str]) -> set[str]:
    """The words, and the beginnings of longer ones, so that inflected forms support each other."""
    distinct = set(words)
    return distinct | {w[:BEGINNING] + "*" for w in distinct if len(w) > BEGINNING}


class ToxicityModel:
    def __init__(self, share: float):
        self.share, self.words, self.weight, self.bias = share, {}, np.zeros(0), None

    def choose_words(self, texts: list[str], labels: np.ndarray) -> None:
        found, positive = Counter(), Counter()
        for text, label in zip(texts, labels):
            present = features(WORD.findall(text.lower()))
            found.update(present)
            if label:
                positive.update(present)
        n, n1 = len(labels), int(labels.sum())
        for word, k in sorted(positive.items()):
            both = found[word] / n
            error = np.sqrt(max(both * (1 - both), 1e-12) * (1 / n1 + 1 / max(1, n - n1)))
            if k >= MIN_DOCS and (k / n1 - (found[word] - k) / max(1, n - n1)) / error >= MIN_Z:
                self.words[word] = len(self.words)

    def _table(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, sentence, word) of every chosen word, and each sentence's document."""
        owner, at, word = [], [], []
        for d, text in enumerate(texts):
            lowered = text.lower()
            for start, end in sentences(lowered):
                for w in features(WORD.findall(lowered, start, end)) & self.words.keys():
                    at.append(len(owner))
                    word.append(self.words[w])
                owner.append(d)
        return np.array(owner, np.int64), np.array(at, np.int64), np.array(word, np.int64)

    def fit(self, texts: list[str], labels: np.ndarray, rounds: int = 300, rate: float = 0.1, ridge: float = 0.02) -> None:
        """Adam on the weighted noisy-or likelihood; labels count as often as they occur."""
        if len(set(labels.tolist())) < 2:
            return
        self.choose_words(texts, labels)
        owner, at, word = self._table(texts)
        y, n = labels.astype(float), len(labels)
        each = np.where(y == 1, self.share / y.mean(), (1 - self.share) / (1 - y.mean()))
        # The last parameter is the bias: at first a whole document of plain sentences is rarely toxic.
        params = np.concatenate([np.full(len(self.words), 3.0), [-np.log(max(1.0, len(owner) / n)) - 3.0]])
        m, v = np.zeros_like(params), np.zeros_like(params)
        for t in range(1, rounds + 1):
            z = params[-1] + np.bincount(at, params[word], minlength=len(owner))
            p = np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), 1e-12, 1 - 1e-9)
            none = np.exp(np.bincount(owner, np.log1p(-p), minlength=n))
            whole = np.clip(1 - none, 1e-9, 1 - 1e-9)
            per_doc = each * np.where(y == 1, (1 - whole) / whole, -1.0)
            d = per_doc[owner] * p
            g = np.append(np.bincount(word, d[at], minlength=len(self.words)) - ridge * params[:-1], d.sum())
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            params = params + rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        self.weight, self.bias = params[:-1], float(params[-1])

    def scores(self, texts: list[str]) -> tuple[list, list, list, list]:
        """Document score, and score, start and length of its most offensive sentence (none: null)."""
        score, worst, start, length = [], [], [], []
        for text in texts:
            if self.bias is None:
                score.append(self.share), worst.append(None), start.append(None), length.append(None)
                continue
            lowered = text.lower()
            # Some letters become two when lower-cased; positions then are those of the text as it is.
            source = lowered if len(lowered) == len(text) else text
            spans = sentences(source)
            z = np.full(len(spans), self.bias)
            if not self.words.keys().isdisjoint(features(WORD.findall(lowered))):
                for i, (a, b) in enumerate(spans):
                    for w in features(WORD.findall(source[a:b].lower())) & self.words.keys():
                        z[i] += self.weight[self.words[w]]
            p = np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), 1e-12, 1 - 1e-9)
            score.append(float(1 - np.exp(np.log1p(-p).sum())))
            best = int(p.argmax()) if len(p) else None
            worst.append(None if best is None else float(p[best]))
            start.append(None if best is None else spans[best][0])
            length.append(None if best is None else spans[best][1] - spans[best][0])
        return score, worst, start, length


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, sample_docs: int = SAMPLE_DOCS) -> ToxicityModel:
    """Fits on labelled rows outside the held-out fold. Without labelled texts of both kinds
    every score is the (smoothed) share of label 1."""
    train = ~held_out(F.col("doc_id"), folds)
    chosen = sample_ids(labels, label, sample_docs, train)
    # At most 2 * sample_docs rows; a repeated doc_id brings the text that sorts first.
    texts = documents_of(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    sample = texts.orderBy("doc_id").toPandas()
    model = ToxicityModel(class_share(labels, label, train))
    model.fit(sample.text.tolist(), sample.label.to_numpy())
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, name: str = "toxicity") -> DataFrame:
    """``docs`` and one more column, a struct of score, sentence_score, sentence_start (in
    characters, from 0) and sentence_length of the most offensive sentence. Null texts count
    as empty; a text without sentences scores 0 and its sentence is null. Equal texts score
    alike; an empty table stays empty; a column of that name is replaced."""

    @F.pandas_udf("score double, sentence_score double, sentence_start int, sentence_length int")
    def judged(texts: pd.Series) -> pd.DataFrame:
        drop_worker_caches()
        score, worst, start, length = model.scores(texts.fillna("").tolist())
        return pd.DataFrame({"score": pd.Series(score, dtype="float64"), "sentence_score": pd.Series(worst, dtype="float64"),
                             "sentence_start": pd.Series(start, dtype="Int32"), "sentence_length": pd.Series(length, dtype="Int32")})

    return docs.withColumn(name, judged("text"))
