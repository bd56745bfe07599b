"""Operators 1 and 4 against plain Python, and the classifier's held-out accuracy."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pytest

from ledgerline.llm import classifier, quality, queries
from ledgerline.llm.textbytes import flat, hashes, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_numbers(text):
    text = text or ""
    found = WORD.findall(text)
    threes = Counter(zip(found, found[1:], found[2:], strict=False))
    covered = {i + k for i, t in enumerate(zip(found, found[1:], found[2:], strict=False)) if threes[t] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def kind_list(text):
    return quality._KIND[np.frombuffer((text or "").encode(), np.uint8)].tolist() if text else []


def plain_model(texts):
    """Modified Kneser-Ney with interpolation, by dictionaries."""
    grams = Counter()
    for t in texts:
        k = [0] * 3 + kind_list(t)
        grams.update(tuple(k[i : i + 4]) for i in range(len(k) - 3))
    levels = [grams]
    while len(next(iter(levels[0]))) > 1:
        levels.insert(0, Counter(g[1:] for g in levels[0]))
    out = []
    for level in levels:
        n = Counter(level.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        cut = {k: min(max(k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k * 0.5, 0.05), k - 0.05) for k in (1, 2, 3)}
        total, left = Counter(), defaultdict(float)
        for g, c in level.items():
            total[g[:-1]] += c
            left[g[:-1]] += cut[min(c, 3)]
        out.append((level, cut, total, left))

    def p(gram):
        if not gram:
            return 1 / quality.KINDS
        level, cut, total, left = out[len(gram) - 1]
        h = gram[:-1]
        if not total[h]:
            return p(gram[1:])
        c = level.get(gram, 0)
        return (c - cut[min(c, 3)] if c else 0) / total[h] + left[h] / total[h] * p(gram[1:])

    return p


def plain_bits(texts):
    p = plain_model(texts)
    out = []
    for t in texts:
        k = [0] * 3 + kind_list(t)
        out.append(-sum(np.log2(p(tuple(k[i : i + 4]))) for i in range(len(k) - 3)) / max(len(k) - 3, 1))
    return out


def test_rules_against_plain_python(spark, messy, messy_texts):
    short = messy.where(F.coalesce(F.length("text"), F.lit(0)) < 5_000)
    got = quality.quality_rules(short).collect()
    texts = {i: t for i, t in enumerate(messy_texts)}
    rows = [(r["doc_id"], r["text"]) for r in short.select("doc_id", "text").collect()]
    bits = dict(zip([t for _, t in rows], plain_bits([t for _, t in rows]), strict=True))
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None:
            text = texts[r["doc_id"]]
            assert tuple(r[1:6]) == base_numbers(text)
            assert r["bits"] == pytest.approx(bits[text], abs=1e-4)
            assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])


def test_rules_on_given_documents(spark, sample):
    got = {r["doc_id"]: r for r in quality.quality_rules(sample).collect()}
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in sample.collect()]
    bits = dict(zip([i for i, *_ in rows], plain_bits([t for _, t, _ in rows]), strict=True))
    limits = {}
    for lang in {x for *_, x in rows}:
        x = sorted(got[i]["bits"] for i, _, g in rows if g == lang and not got[i]["base_failed"])
        q1, q3 = (x[int(np.ceil(q * len(x))) - 1] for q in (0.25, 0.75))
        limits[lang] = (q1 - quality.BAND * max(q3 - q1, 0.02), q3 + quality.BAND * max(q3 - q1, 0.02))
    for i, t, lang in rows:
        r = got[i]
        assert tuple(r[1:6]) == base_numbers(t)
        assert r["bits"] == pytest.approx(bits[i], abs=1e-4)
        low, high = limits[lang]
        assert r["kept"] == (not r["base_failed"] and low <= r["bits"] <= high)


@pytest.mark.parametrize("copies", [False, True])
def test_junk_of_a_third_of_a_language_goes(spark, copies):
    """Random strings, distinct or copies of one text, are a third of the Spanish rows: all go, and good documents stay."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    n = docs.where("lang = 'es'").count()
    rng = np.random.default_rng(2)
    letters = np.array(list("bcdfghjklmnpqrstvwxz0123456789#%&"))
    junk = [" ".join("".join(rng.choice(letters, rng.integers(3, 10))) for _ in range(200)) for _ in range(n // 2)]
    rows = [(10**7 + i, junk[0 if copies else i], "es") for i in range(len(junk))]
    got = quality.quality_rules(docs.unionByName(spark.createDataFrame(rows, docs.schema))).where("not base_failed").collect()
    assert not any(r["kept"] for r in got if r["doc_id"] >= 10**7)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").collect()
    good = {r["doc_id"] for r in labels}
    assert np.mean([r["kept"] for r in got if r["doc_id"] in good]) > 0.98


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(3)
    counts = np.zeros(quality.KINDS**4, np.int64)
    counts[rng.integers(0, len(counts), 3000)] = rng.geometric(0.3, 3000)
    p = np.exp2(quality.kneser_ney(counts).log2(np.arange(len(counts)))).reshape(-1, quality.KINDS)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)


def test_no_rows(nothing):
    assert quality.quality_rules(nothing).collect() == []
    assert classifier.score_quality(nothing, nothing.select("doc_id", F.lit(1).alias("quality")), F.lit(True)).collect() == []


def test_words_and_their_hashes():
    texts = ["", "a bb", "  x\ty ", "é\n" * 3, "z" * 9000 + " " + "z" * 4097]
    data, ends = flat(pa.array(texts))
    start, stop, doc = words(data, ends)
    found = [(int(d), bytes(data[a:b]).decode()) for a, b, d in zip(start, stop, doc, strict=True)]
    assert found == [(i, w) for i, t in enumerate(texts) for w in WORD.findall(t)]
    by_word = defaultdict(set)
    for (_, w), h in zip(found, hashes(data, start, stop), strict=True):
        by_word[w].add(int(h))
    assert all(len(x) == 1 for x in by_word.values())
    assert len(set.union(*by_word.values())) == len(by_word)


def test_context_sums_against_plain_python(spark, sample):
    got = classifier.context_sums(sample.limit(40), group_bytes=5_000)
    places, signs = classifier.index_vectors()
    want = np.zeros_like(got)
    for r in sample.limit(40).collect():
        ids, _ = classifier.word_ids(pa.array([r["text"]]))
        for i, w in enumerate(ids.tolist()):
            for j in range(max(0, i - 2), min(len(ids), i + 3)):
                if j != i:
                    np.add.at(want[w], places[ids[j]], signs[ids[j]])
    assert np.array_equal(got, want)


def test_scores_of_messy_rows(spark, messy, sample):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = classifier.score_quality(sample.unionByName(messy.select(*sample.columns)), labels, F.col("doc_id") % 2 == 0).collect()
    assert len(got) == sample.count() + messy.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    none = classifier.score_quality(messy, labels, F.lit(False)).collect()
    assert {r["score"] for r in none} == {0.5}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.op1_quality_classifier(spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)
    y, p = np.array([r["quality"] for r in rows]), np.array([r["score"] for r in rows])
    base = max(y.mean(), 1 - y.mean())
    assert ((p >= 0.5) == y).mean() > base + 0.6 * (1 - base)
    loss = -np.mean(np.log(np.clip(np.where(y == 1, p, 1 - p), 1e-9, 1)))
    assert loss < 0.15
