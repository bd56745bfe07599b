"""The registered queries of the numbered operators, and SQL where it can express one."""

from __future__ import annotations

import public_tokenizers
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import (
    binary_output, bpe, classifier, embeddings, filter_audit, jaccard, packing, parsing, periodic, quality, sharding, substrings, tokens,
)
from ledgerline.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _held_out():
    """Documents that no label may be learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = classifier.score_quality(_docs(spark, sf_dir), labels, learn=~_held_out())
    return scores.select("doc_id", _held_out().alias("held_out"), "score", "predicted")


def op2_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.bounded_ring(_docs(spark, sf_dir), shards=24)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_docs(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_docs(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_output.round_trip(_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op7_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_docs(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least=0.95)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_documents(_docs(spark, sf_dir))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.edited_fingerprints(_docs(spark, sf_dir))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.planted_runs(_docs(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_classifier, op2_hash_ring, op3_suffix_dedup, op4_quality_rules, op5_token_counts, op6_token_output,
        op7_bpe_automaton, op8_near_vectors, op9_best_fit_packing, op10_jaccard_join,
        op11_filter_audit, op12_phrase_fingerprints, op13_periodic_runs,
    )
}
