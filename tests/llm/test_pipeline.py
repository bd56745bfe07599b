"""Each stage of the pipeline against plain Python, on the stage's own input."""

import os
from collections import Counter

import numpy as np
import pyspark.sql.functions as F
import pytest
from test_near import plain_documents
from test_quality import base_numbers, plain_bits
from test_substrings import plain
from test_token_operators import check_packing

import __spark_entry__
import corpus_pipeline
from ledgerline.llm import quality, substrings

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The input and output of each stage over sf0.001 with some messy rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.orderBy("doc_id").first()
    odd = [(None, first["text"], "en", "s", None), (9000, None, None, None, 0), (9001, "", "en", "s", 0), tuple(first), tuple(first)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    root = str(tmp_path_factory.mktemp("stages"))
    found = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(os.path.join(root, name))
        out = spark.read.parquet(os.path.join(root, name))
        found.append((name, docs, out))
        docs = out
    return found


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_names_and_columns(steps):
    assert [n for n, _, _ in steps] == ["quality_rules", "quality_classifier", "near_duplicates", "repeated_passages", "best_fit_packing"]
    assert all(out.columns == docs.columns for _, docs, out in steps[:-1])
    assert "pipeline" in __spark_entry__.queries()


def test_quality_rules(steps):
    _, docs, out = steps[0]
    rows = docs.collect()
    bits = plain_bits([r["text"] for r in rows])
    good = [n >= 50 and 100 * again <= 50 * n for n, *_, again in (base_numbers(r["text"]) for r in rows)]
    want = Counter()
    for lang in {r["lang"] for r in rows}:
        x = sorted(b for b, g, r in zip(bits, good, rows, strict=True) if g and r["lang"] == lang)
        if x:
            q1, q3 = (x[int(np.ceil(q * len(x))) - 1] for q in (0.25, 0.75))
            wide = quality.BAND * max(q3 - q1, 0.02)
            want.update(tuple(r) for b, g, r in zip(bits, good, rows, strict=True) if g and r["lang"] == lang and q1 - wide <= b <= q3 + wide)
    assert Counter(map(tuple, out.collect())) == want


def test_quality_classifier(spark, steps):
    _, docs, out = steps[1]
    assert not out.exceptAll(docs).count()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    went = [labels[r["doc_id"]] for r in docs.exceptAll(out).collect() if r["doc_id"] in labels]
    stayed = [labels[r["doc_id"]] for r in out.collect() if r["doc_id"] in labels]
    assert np.mean(stayed) > 0.9 and sum(went) <= max(1, len(went) // 3)


def test_near_duplicates(steps):
    _, docs, out = steps[2]
    keep = {i for i, _, c in plain_documents(texts(docs)) if i is None or i == c}
    assert Counter(map(tuple, out.collect())) == Counter(tuple(r) for r in docs.collect() if r["doc_id"] in keep)


def test_repeated_passages(steps):
    _, docs, out = steps[3]
    want = plain(texts(docs))
    assert Counter((k[0], k[1] - k[2]) for k in want.elements()) == Counter(
        (r["doc_id"], r["n"]) for r in substrings.remove_repeats(docs).selectExpr("doc_id", "n_bytes - n_removed as n").collect()
    )
    left = {i: len((t or "").encode()) for i, t in texts(out)}
    for i, n, gone, n_spans, _ in want.elements():
        assert n - gone <= left[i] <= n - gone + 6 * n_spans
    assert out.where(F.col("n_chars") != F.length("text")).count() == 0


def test_packing(steps):
    _, docs, out = steps[4]
    check_packing(out, docs, 2048)


def test_run_equals_its_stages(spark, tmp_path):
    got = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, docs.collect()))


def test_stages_of_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_a_column_named_like_the_row_key_is_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clash = docs.withColumn("row_key", F.col("doc_id") * 2)
    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.quality_classifier):
        out = stage(spark, clash, SF)
        rows = out.collect()
        assert out.columns == clash.columns and rows
        assert all(r["row_key"] == 2 * r["doc_id"] for r in rows)
