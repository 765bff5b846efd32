"""The registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import embeddings, exact_dedup, line_dedup, lm_scoring, minhash, mixing, packing, prefix_trie, quality, source_audit, suffix_dedup, token_counts, toxicity
from .common import held_out


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    scores = token_counts.zipf_scores(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(_table(spark, folder, "documents"), scores)


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = line_dedup.dedup_lines(_table(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_removed_chunks", "n_removed_lines",
                      F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op2_line_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """All repeated blocks of two or more lines, which the recall of op2_line_dedup is measured against."""
    out = line_dedup.dedup_line_blocks(_table(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_removed_lines", F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, folder, "documents"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack_documents(
        _table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "loss_tokens")


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every source gets the same share of a mixture as large as the corpus."""
    return mixing.mix_sources(_table(spark, folder, "documents")).select(
        "doc_id", "source", "copy_no", F.round("mix_rate", 9).alias("mix_rate"), "mix_order", "text")


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = quality.fit_quality(docs, _table(spark, folder, "labels"))
    scored = quality.score_quality(docs.select("doc_id", "text"), model, "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, folder, "embeddings"))


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_dedup(_table(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = toxicity.fit_toxicity(docs, _table(spark, folder, "labels"))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model, "t")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "t.score",
                         (F.col("t.score") >= 0.5).cast("int").alias("predicted"),
                         "t.sentence_score", "t.sentence_start", "t.sentence_length")


def op11_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """One training document in ten is deleted from the counts to learn the weights."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    scored = lm_scoring.score_documents(
        _table(spark, folder, "documents"), F.pmod(fold, F.lit(7)) == 2, F.pmod(F.floor(fold / 7), F.lit(10)) == 0)
    return scored.select("doc_id", F.col("test").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return source_audit.audit_sources(_table(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_line_dedup, op2_line_blocks, op3_exact_dedup, op4_packing, op5_suffix_dedup, op6_mixing,
                            op7_quality, op8_near_vectors, op9_near_dedup, op10_toxicity, op11_lm_scoring,
                            op12_source_audit, op13_prefix_trie)
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
