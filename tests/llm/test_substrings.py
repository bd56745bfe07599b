"""Operator 3 against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import substrings


def plain(rows):
    """By the contract; rows of one id with one text are one document."""
    order = sorted({((i is not None, i), (t or "").encode()) for i, t in rows})
    seen, out = set(), {}
    for i, data in order:
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 99):
            s = data[k : k + 100]
            if s in seen:
                gone[k : k + 100] = True
            seen.add(s)
        n_spans = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(data) else 0
        out[i[1], data] = (len(data), int(gone.sum()), n_spans, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
    return Counter((i, *out[i, (t or "").encode()]) for i, t in rows)


def result(df, **options):
    return Counter(map(tuple, substrings.remove_repeats(df, **options).collect()))


def word_salad(rng, n):
    return " ".join("".join(rng.choice(list("abcdeé"), rng.integers(2, 7))) for _ in range(n))


def crafted():
    rng = np.random.default_rng(9)
    rows = []
    passages = [word_salad(rng, 60)[:n] for n in (99, 100, 101, 130, 169, 170, 250)]
    for k in range(120):
        parts = [word_salad(rng, int(rng.integers(1, 30)))]
        for _ in range(rng.integers(0, 3)):
            parts += [passages[rng.integers(len(passages))], word_salad(rng, int(rng.integers(0, 12)))]
        rows.append((k, "".join(parts)))
    base = word_salad(rng, 300)
    for k in range(200, 230):
        words = base.split(" ")
        for _ in range(rng.integers(0, 12)):
            words[rng.integers(len(words))] = word_salad(rng, 1)
        rows.append((k, " ".join(words)))
    rows += [(300, "ab" * 2000), (301, "ab" * 90), (302, "z" * 5000), (303, "x" + "z" * 120), (304, "abc" * 333), (305, base * 3)]
    rows += [(k, base) for k in range(400, 440)]
    return [rows[i] for i in rng.permutation(len(rows))]


@pytest.mark.parametrize("hot", [20_000, 2])
def test_crafted_repeats(spark, hot):
    rows = crafted()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert result(df, hot=hot) == plain(rows)


def test_messy_rows(spark, messy, nothing):
    rows = [(r["doc_id"], r["text"]) for r in messy.select("doc_id", "text").collect()]
    assert result(messy) == plain(rows)
    assert result(nothing) == Counter()


def test_one_id_with_several_texts(spark):
    text = crafted()[0][1] + "q" * 150
    rows = [(1, text), (1, text), (2, "head " + text), (2, text + " tail"), (2, text + " tail")]
    got = result(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sum(got.values()) == 5
    assert [n for k, n in got.items() if k[0] == 1] == [2]
    by_two = [k for k in got if k[0] == 2]
    assert len(by_two) == 2 and all(k[2] >= len(text) for k in by_two)


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    assert result(df.repartition(7)) == plain(rows)


def test_shortened_rows_keep_their_columns(spark, messy):
    got = substrings.shortened(messy)
    assert got.columns == messy.columns and got.count() == messy.count()
    kept = {r["doc_id"]: r["text"] for r in got.collect()}
    assert kept[0] is None and kept[4] == "a" and kept[5] is not None
    assert "�" not in "".join(t or "" for t in kept.values())


def test_buckets_are_equal_where_bytes_are():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 2, 3000).astype(np.uint8)
    data[1500:1800] = data[100:400]
    anchor, whole = substrings.buckets(data)
    for ids, n in ((anchor, 32), (whole, 100)):
        assert len(ids) == len(data) - n + 1
        by_bytes, by_id = {}, {}
        for k in range(len(ids)):
            key = data[k : k + n].tobytes()
            assert by_bytes.setdefault(key, int(ids[k])) == int(ids[k])
            assert by_id.setdefault(int(ids[k]), key) == key


def test_segments_cover_all_strings():
    texts = [t for _, t in crafted()]
    data, ends = substrings.flat(pa.array(texts))
    found = substrings.segments(data, ends)
    places = Counter()
    for d, p, n in zip(found["doc"], found["place"], found["size"], strict=True):
        places.update((int(d), int(p) + k) for k in range(n))
    assert set(places.values()) == {1}
    assert set(places) == {(d, k) for d, t in enumerate(texts) for k in range(len(t.encode()) - 99)}
