"""Operator 13 against trying every period at every word."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pyspark.sql.functions as F
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import periodic


def runs_by_hand(words, least=6, exponent=4):
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, exponent * q):
                run = words[i : i + length]
                if not any(all(run[x] == run[x + p] for x in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted_by_hand(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def row_by_hand(doc_id, text):
    words = planted_by_hand(doc_id, words_of(text))
    runs = runs_by_hand(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def found_in(lists):
    codes = {w: i for i, w in enumerate(dict.fromkeys(w for x in lists for w in x))}
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    runs = periodic.find_runs(np.array([codes[w] for x in lists for w in x], np.int64), ends)
    out = [[] for _ in lists]
    for s, n, q in runs.tolist():
        d = int(np.searchsorted(ends, s, "right")) - 1
        out[d].append((s - int(ends[d]), n, q))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(1, 12)), max_size=5), max_size=4))
def test_runs_of_any_words(documents):
    """Pieces repeated some times, one after the other: nested, touching and overlapping runs."""
    lists = [[w for piece, times in doc for w in piece * times] for doc in documents]
    assert found_in(lists) == [runs_by_hand(x) for x in lists]


def test_long_runs_and_random_words():
    r = np.random.default_rng(5)
    lists = [r.integers(0, k, 700).tolist() for k in (1, 2, 3, 50)] + [list(range(97)) * 7, [0] * 3 + list(range(50)) * 4 + [1] * 9]
    lists += [([0] * 8 + [1]) * 12, [int(b) for i in range(300) for b in bin(i)[2:]]]
    assert found_in(lists) == [runs_by_hand(x) for x in lists]


def test_fewer_than_four_periods_are_refused():
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(9, np.int64), np.array([0, 9]), exponent=3)


def test_successor_queries_of_the_tree():
    r = np.random.default_rng(1)
    values = r.permutation(300)
    tree = periodic.WaveletTree(values)
    low = r.integers(0, 299, 500)
    high = low + 1 + r.integers(0, 300, 500) % (300 - low)
    x, place = r.integers(0, 300, 500), r.integers(0, 300, 500) % (high - low)
    assert tree.rank(low, high, x).tolist() == [int((values[a:b] < v).sum()) for a, b, v in zip(low, high, x)]
    assert tree.quantile(low, high, place).tolist() == [int(np.sort(values[a:b])[k]) for a, b, k in zip(low, high, place)]


@pytest.mark.parametrize("group_bytes", [50, 2_000_000])
def test_runs_and_collapsed_texts(messy, group_bytes):
    """Nulls, blanks of all kinds, long texts, repeated rows and ids, columns of clashing names."""
    got = periodic.periodic_runs(messy.withColumnRenamed("words", "runs"), group_bytes=group_bytes).collect()
    want = []
    for r in messy.select("doc_id", "text").collect():
        words = words_of(r["text"])
        runs = [(0, 5_000, 1)] if words == ["word"] * 5_000 else runs_by_hand(words[:2_000]) if len(words) < 2_000 else None
        if runs is None:  # the long prose: one sentence 400 times
            runs = [(0, len(words), 17)] if words[:17] == words[17:34] else runs_by_hand(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append((r["doc_id"], runs, " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=repr) == sorted(want, key=repr)


def test_query_against_brute_force(spark, sample):
    rows = [(i, t) for i, t in [(None, "a " * 9), (40, None), (40, ""), (43, "x"), (43, "x"), (97, " \n")]]
    docs = sample.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id bigint, text string")).withColumn("runs", F.lit(1))
    short = docs.where(F.size(F.split("text", " ")) < 1_500)
    got = periodic.planted_runs(short)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for c, t in got.dtypes if c != "doc_id"} == {"bigint", "string"}
    want = [row_by_hand(r["doc_id"], r["text"]) for r in short.collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) > 5


def test_planted_texts_are_found(sample):
    """Every planted stretch of four periods and six words is in a run."""
    ids = [r["doc_id"] for r in sample.select("doc_id").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0]
    rows = {r["doc_id"]: r for r in periodic.planted_runs(sample).where(F.col("doc_id").isin(ids)).collect()}
    for r in sample.where(F.col("doc_id").isin(ids)).collect():
        g, n = zlib.crc32(str(r["doc_id"]).encode()) // 10, len(words_of(r["text"]))
        a = g % n
        if (n - a) >= max(6, 4 * (1 + (n - a) // (3 + g % 8))):
            assert rows[r["doc_id"]]["n_runs"] > 0


def test_nothing(nothing):
    assert periodic.planted_runs(nothing).collect() == []
