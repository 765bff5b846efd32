"""Nearest entities to a few given ones: by cosine over numeric vectors, by vector and words
together, and from a stored index that leaves out what cannot be among the nearest."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import any_of, contains_folded
from ..operators.keyed import first_per_key

#: Query vectors that one scan of the entities scores.
QUERY_BLOCK = 256


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _directed(entities: DataFrame) -> DataFrame:
    """Vectors as doubles, with their norm. An all-zero vector has no direction and no row."""
    vectors = entities.withColumn("vector", F.transform("vector", lambda x: x.cast("double")))
    return vectors.withColumn("norm", F.sqrt(_dot(F.col("vector"), F.col("vector")))).filter("norm > 0")


def _cosines(vectors: DataFrame, candidates: DataFrame, wanted: Sequence) -> DataFrame:
    """The rows of ``candidates`` once per other entity asked for, with query_id and cosine.

    The query vectors arrive as one scalar subquery; nothing is joined."""
    packed = F.collect_list(F.struct(F.col("id").alias("qid"), F.col("vector").alias("qv"), F.col("norm").alias("qn")))
    # One vector per id, so the list is no longer than the ids asked for.
    asked = vectors.filter(F.col("id").isin(wanted)).groupBy("id").agg(
        F.min("vector").alias("vector"), F.min("norm").alias("norm"))
    # The subquery is a column of its own because lambdas may not hold subqueries.
    pairs = candidates.withColumn("_queries", asked.agg(packed.alias("q")).scalar()).withColumn("_q", F.explode("_queries"))
    pairs = pairs.filter(F.col("id") != F.col("_q.qid"))
    cosine = _dot(F.col("vector"), F.col("_q.qv")) / (F.col("norm") * F.col("_q.qn"))
    return pairs.select("*", F.col("_q.qid").alias("query_id"), cosine.alias("cosine"))


def _nearest(pairs: DataFrame, score: Column, k: int, digits: int) -> DataFrame:
    scored = pairs.select("query_id", "id", F.round(score, digits).alias("score"))
    return first_per_key(scored, ["query_id"], [F.col("score").desc(), F.col("id")], k)


def _by_blocks(query_ids: Sequence, answer: Callable[[list], DataFrame]) -> DataFrame:
    """``answer`` to at most `QUERY_BLOCK` ids at a time."""
    wanted = list(dict.fromkeys(query_ids))
    blocks = [wanted[i : i + QUERY_BLOCK] for i in range(0, len(wanted), QUERY_BLOCK)] or [[]]
    return reduce(DataFrame.unionByName, [answer(b) for b in blocks])


def similar_entities(
    entities: DataFrame, query_ids: Sequence, k: int = 10, keywords: Sequence[str] = (), digits: int = 6
) -> DataFrame:
    """For each query id the ``k`` most similar other entities (id, vector[, text]).

    Exact: every entity is scored against every query, `QUERY_BLOCK` of them in one scan, and
    the top k are cut inside each task before the shuffle. ``keywords`` keeps entities whose
    text contains any of them. Ties go to the smaller id.
    """
    vectors = _directed(entities)
    candidates = vectors.filter(any_of([contains_folded("text", w) for w in keywords])) if keywords else vectors
    return _by_blocks(query_ids, lambda ids: _nearest(_cosines(vectors, candidates, ids), F.col("cosine"), k, digits))


def term_index(entities: DataFrame) -> DataFrame:
    """term, id and n: how often each word of an entity's text (id, text) stands in it.

    Words are runs of letters and digits in lower case. An entity without text has no row.
    Store it sorted by term, so that reading a few terms skips the other row groups."""
    words = F.split(F.lower("text"), r"[^\p{L}\p{N}]+")
    return entities.select("id", F.explode(words).alias("term")).filter("term != ''").groupBy("term", "id").agg(
        F.count(F.lit(1)).alias("n"))


def keyword_scores(index: DataFrame, keywords: Sequence[str], n_entities: Column) -> DataFrame:
    """id and keyword_score, from 0 to 1, of the entities that hold a word of ``keywords``.

    Rare words weigh more: each found word adds its inverse document frequency times n / (n + 1)
    for its n occurrences; the sum is divided by that of all found words' frequencies."""
    wanted = sorted({w for k in keywords for w in re.split(r"[\W_]+", k.lower()) if w})
    hits = index.filter(F.col("term").isin(wanted))
    holders = hits.groupBy("term").agg(F.count(F.lit(1)).alias("holders"))
    rarity = F.ln(1 + (n_entities - F.col("holders") + 0.5) / (F.col("holders") + 0.5))
    # One row per word asked for, at most.
    weights = holders.select("term", rarity.alias("weight"))
    total = weights.agg(F.sum("weight")).scalar()
    scores = hits.join(F.broadcast(weights), "term").groupBy("id").agg(
        F.sum(F.col("weight") * F.col("n") / (F.col("n") + 1)).alias("found"))
    return scores.select("id", (F.col("found") / total).alias("keyword_score"))


def hybrid_entities(
    entities: DataFrame, query_ids: Sequence, keywords: Sequence[str], k: int = 10, keyword_weight: float = 0.5,
    digits: int = 6, index: DataFrame | None = None,
) -> DataFrame:
    """For each query id the ``k`` other entities with the best mix of cosine and `keyword_scores`.

    Unlike the filter of `similar_entities`, an entity without any of the words takes part with
    a keyword score of 0. ``index`` is a stored `term_index`; without one it is made of the
    entities' texts. Ties go to the smaller id.
    """
    vectors = _directed(entities)
    words = keyword_scores(term_index(entities) if index is None else index, keywords, entities.agg(F.count(F.lit(1))).scalar())
    candidates = vectors.join(words, "id", "left")
    score = F.col("cosine") * (1 - keyword_weight) + F.coalesce("keyword_score", F.lit(0.0)) * keyword_weight
    return _by_blocks(query_ids, lambda ids: _nearest(_cosines(vectors, candidates, ids), score, k, digits))


def pivot_index(
    entities: DataFrame, n_pivots: int = 64, sample_rows: int = 8192, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """The entities (id, vector) with ``cell`` and ``angle``, and the pivots (cell, vector).

    A cell holds the entities nearest to one pivot; the angle is that to the pivot. Pivots are
    the centres of a k-means fitted on ``sample_rows`` entities, picked by a hash of the id; every
    entity is indexed. Vectors without direction or with non-finite numbers have no row. Store
    the index with ``partitionBy("cell")``, so that `indexed_neighbours` reads only the cells it
    needs, and the pivots as they are. No entities give an empty index without pivots."""
    spark = entities.sparkSession
    vectors = _directed(entities).filter(F.col("norm") < math.inf)
    unit = vectors.select("id", F.transform("vector", lambda x: x / F.col("norm")).alias("vector"))
    featured = unit.withColumn("features", array_to_vector("vector"))
    sample = featured.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("features")
    schema = "cell int, vector array<double>"
    if sample.isEmpty():
        empty = unit.select("id", "vector", F.lit(0).alias("cell"), F.lit(0.0).alias("angle")).limit(0)
        return empty, spark.createDataFrame([], schema)
    model = KMeans(k=n_pivots, distanceMeasure="cosine", seed=seed, maxIter=10).fit(sample)
    centres = [c / np.linalg.norm(c) for c in model.clusterCenters()]
    pivots = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)], schema)
    placed = model.transform(featured).select("id", "vector", F.col("prediction").alias("cell"))
    # n_pivots rows.
    both = placed.join(F.broadcast(pivots.withColumnRenamed("vector", "pivot")), "cell")
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _dot(F.col("vector"), F.col("pivot"))))
    return both.select("id", "vector", "cell", F.acos(cosine).alias("angle")), pivots


def _reachable(index: DataFrame, pivots: DataFrame, wanted: Sequence, k: int, digits: int) -> DataFrame:
    """The rows of ``index`` that may be among the ``k`` nearest of an entity asked for.

    The angle between two entities is at least the difference of their angles to any pivot. The
    nearest cells give a first k-th score for each query; its angle bounds what else is read."""
    centres = sorted((r["cell"], r["vector"]) for r in pivots.collect())
    asked = index.filter(F.col("id").isin(wanted)).groupBy("id").agg(F.min("vector").alias("vector")).collect()
    if not centres or not asked:
        return index.limit(0)
    matrix = np.array([v for _, v in centres])
    apart = {r["id"]: np.arccos(np.clip(matrix @ np.array(r["vector"]), -1.0, 1.0)) for r in asked}
    near = {centres[int(a.argmin())][0] for a in apart.values()}
    vectors = _directed(index)
    found = _nearest(_cosines(vectors, vectors.filter(F.col("cell").isin(sorted(near))), wanted), F.col("cosine"), k, digits)
    # At most k rows for each of the ids asked for: one row per id comes back.
    last = {r["query_id"]: r for r in found.groupBy("query_id").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n")).collect()}

    def reach(entity) -> float:
        row = last.get(entity)
        # The k-th score is rounded; a lower one by a digit can't come in any more.
        return math.pi if row is None or row["n"] < k else math.acos(max(-1.0, min(1.0, row["score"] - 10.0**-digits))) + 1e-6

    spans = {e: reach(e) for e in apart}
    parts = []
    for i, (cell, _) in enumerate(centres):
        low, high = min(a[i] - spans[e] for e, a in apart.items()), max(a[i] + spans[e] for e, a in apart.items())
        parts.append((F.col("cell") == cell) & F.col("angle").between(float(low), float(high)))
    return index.filter(reduce(or_, parts))


def indexed_neighbours(index: DataFrame, pivots: DataFrame, query_ids: Sequence, k: int = 10, digits: int = 6) -> DataFrame:
    """What `similar_entities` gives without keywords, from a stored `pivot_index`.

    Exact: rows are left out only where the angles to their pivot prove them too far away. How
    many that are depends on the data: most where entities lie in groups, none where vectors
    point everywhere alike. Only the query vectors and the pivots reach the driver."""

    def answer(ids: list) -> DataFrame:
        vectors = _directed(index)
        return _nearest(_cosines(vectors, _directed(_reachable(index, pivots, ids, k, digits)), ids), F.col("cosine"), k, digits)

    return _by_blocks(query_ids, answer)
