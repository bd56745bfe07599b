"""The corpus pipeline: quality rules, quality classifier, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written and read again as the next stage's
``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession

from ledgerline.llm import classifier, jaccard, packing, quality, substrings
from ledgerline.llm.shared import Scratch


def _row_key() -> Column:
    """Names a row by its id, language and text; no part is null."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in ("doc_id", "lang", "text")]
    return F.md5(F.concat_ws("|", *parts))


def _free(docs: DataFrame, name: str) -> str:
    """The name, with as many underscores behind it as make it none of the columns."""
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def _staying(docs: DataFrame, verdicts: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` whose key is among those of ``verdicts``."""
    keyed = docs.withColumn(key, _row_key())
    return keyed.join(verdicts.select(key).distinct(), key, "left_semi").select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule, or whose perplexity is outside their language's band, go."""
    key = _free(docs, "row_key")
    verdicts = quality.quality_rules(docs.withColumn(key, _row_key()), id_col=key)
    return _staying(docs, verdicts.where("kept"), key)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for label 0 go.  Labels are learned as in operator 1."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    key = _free(docs, "row_key")
    keyed = docs.withColumn(key, _row_key())
    # One row for each row of the stage's input: labels belong to ids, scores to rows.
    marked = keyed.select("doc_id", key).distinct().join(labels.select("doc_id", "quality").distinct(), "doc_id")
    learn = marked.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1).select(key, "quality")
    scores = classifier.score_quality(keyed, learn, learn=F.lit(True), id_col=key)
    return _staying(docs, scores.where("predicted = 1"), key)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays, and all rows without an id.

    Rows of one id are one document and stay or go together.
    """
    groups = jaccard.near_documents(docs)
    return docs.join(groups.where("component_id != doc_id").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that start earlier go from the texts; n_chars counts what is left."""
    found = substrings.shortened(docs)
    if "n_chars" not in docs.columns:
        return found
    return found.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("best_fit_packing", best_fit_packing),
]

#: Neither perplexities nor the network nor token ids can be said in SQL; tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
