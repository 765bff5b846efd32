"""From raw documents to packed training sequences, in five stages.

Every stage works on all that its predecessor kept; the tool or `run` writes its rows as
Parquet and reads them again for the next. Stages take nulls, empty texts and empty tables as
the operators they call define them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from journeylake.llm import exact_dedup, minhash, mixing, packing, toxicity
from journeylake.llm.common import free_name, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.5 or more, by a model fitted on those that have labels.

    A null text scores as an empty one. Rows without doc_id, repeated ids and repeated rows are
    judged one by one by their texts, however long; names of further columns don't matter, and
    an empty table stays empty."""
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = free_name(docs.columns, "toxicity")
    return toxicity.score_toxicity(docs, model, name).filter(F.col(f"{name}.score") < 0.5).select(*docs.columns)


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(and_, (left[n].eqNullSafe(right[n]) for n in names))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that with the largest doc_id.

    Null texts count as empty, so one of the empty ones stays. A row without doc_id is the
    smallest; where several rows have the largest id and one text, one of them stays. Rows of
    one id with different texts are judged apart. An empty table stays empty. The rows that go,
    few beside the texts, are what the join brings along."""
    id_, sha = free_name(docs.columns, "id"), free_name(docs.columns, "sha")
    decisions = written(exact_dedup.exact_dedup(docs), "pipeline-exact").select(
        F.col("doc_id").alias(id_), F.col("text_sha256").alias(sha), "kept")
    counts = decisions.groupBy(id_).agg(F.count(F.lit(1)).alias("n"), F.bool_and("kept").alias("kept"))
    shared = written(counts.filter(f"n > 1 or {id_} is null").select(id_), "pipeline-exact-shared")
    gone = written(counts.filter("n = 1 and not kept").select(id_), "pipeline-exact-gone")
    keyed = docs.withColumn(id_, F.col("doc_id").cast("long"))
    out = keyed.join(shared, _same(keyed, shared, [id_]), "left_anti").join(gone, id_, "left_anti")
    # Rows that share an id are told apart by their texts.
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    odd = keyed.join(shared, _same(keyed, shared, [id_]), "left_semi").withColumn(sha, F.sha2(text.cast("binary"), 256))
    stay = decisions.filter("kept").join(shared, _same(decisions, shared, [id_]), "left_semi").select(id_, sha).distinct()
    odd = odd.join(stay, _same(odd, stay, [id_, sha]), "left_semi").dropDuplicates([id_, sha])
    return out.unionByName(odd.drop(sha)).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id.

    Null, empty and blank texts have no shingle and stay. Rows that have no doc_id, or one that
    another row has too, are documents of their own: they take part under numbers beyond the
    largest id, so each is judged by its own text. An empty table stays empty."""
    key = free_name(docs.columns, "key")
    counts = docs.groupBy(F.col("doc_id").cast("long").alias(key)).agg(F.count(F.lit(1)).alias("n"))
    shared = written(counts.filter(f"n > 1 or {key} is null").select(key), "pipeline-near-shared")
    keyed = docs.withColumn(key, F.col("doc_id").cast("long"))
    odd = keyed.join(shared, _same(keyed, shared, [key]), "left_semi")
    largest = docs.agg(F.max(F.col("doc_id").cast("long"))).first()[0] or 0
    odd = written(odd.withColumn(key, F.lit(largest + 1) + F.monotonically_increasing_id()), "pipeline-near-odd")
    rows = keyed.join(shared, _same(keyed, shared, [key]), "left_anti").unionByName(odd)
    decisions = minhash.near_dedup(rows.select(F.col(key).alias("doc_id"), "text"))
    gone = written(decisions.filter("not kept").select(F.col("doc_id").alias(key)), "pipeline-near-gone")
    return rows.join(gone, key, "left_anti").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source with the same share of a mixture of as many rows, in random order.

    A null source is the source ''. Rows equal in doc_id draw alike, those without one too; texts
    of any kind come along whole. An empty table stays empty."""
    return mixing.mix_sources(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of 2048 tokens, with their ids.

    A null or empty text is its end token. Every row is packed, also repeated ones and those
    without doc_id; a long text is cut into pieces. An empty table gives no pieces."""
    # Less memory for words than by default: the stages before have left their own in the executor.
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), cached_bytes=32 << 20)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
