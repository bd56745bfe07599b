"""Operator 12: the parse against a plain one, symbol by symbol, and what fingerprints promise."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import parsing

MASK = (1 << 64) - 1
STEP, SEED = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def toss(left, own):
    place = ((left ^ own) & -(left ^ own)).bit_length() - 1
    return 2 * place + (own >> place & 1)


def names_by_hand(text, least):
    """Names of phrases of ``least`` code points or more, and the whole text's name."""
    symbols, found = [(ord(c), 1) for c in text], []
    while symbols:
        runs = []
        for s, n in symbols:
            if runs and runs[-1][0] == s:
                runs[-1][1] += 1
            else:
                runs.append([s, 1, n])
        symbols = [(s if t == 1 else mix((s * STEP + t) & MASK), n * t) for s, t, n in runs]
        if len(symbols) == 1:
            return found, mix((symbols[0][0] + SEED) & MASK)
        label = [s for s, _ in symbols]
        for _ in range(4):
            label = [toss(label[i - 1] if i else x ^ 1, x) for i, x in enumerate(label)]
            assert all(a != b for a, b in zip(label, label[1:]))
        assert max(label) < 6
        starts = [0] + [i for i in range(1, len(label) - 1) if label[i - 1] < label[i] > label[i + 1]]
        phrases = [symbols[a:b] for a, b in zip(starts, [*starts[1:], len(symbols)])]
        symbols = [(mix(sum(mix((s + STEP * (i + 1)) & MASK) for i, (s, _) in enumerate(p)) & MASK), sum(n for _, n in p)) for p in phrases]
        found += [s for s, n in symbols if n >= least]
    return found, 0


def names_of(texts, least):
    points = [np.array([ord(c) for c in t], np.uint32) for t in texts]
    ends = np.concatenate([[0], np.cumsum([len(p) for p in points])]).astype(np.int64)
    name, owner, whole = parsing.names(np.concatenate([*points, np.zeros(0, np.uint32)]), ends, least)
    return [(sorted(name[owner == i].tolist()), int(whole[i])) for i in range(len(texts))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab c\nédZ日😀"), max_size=120) | st.text(st.sampled_from("ab"), max_size=60), max_size=6), st.integers(1, 30))
def test_parse_equals_the_plain_one(texts, least):
    assert names_of(texts, least) == [(sorted(n), w) for n, w in (names_by_hand(t, least) for t in texts)]


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("the of and \n"), max_size=50), st.text(st.sampled_from("xyz 12"), max_size=50), st.integers(0, 2**32))
def test_equal_substrings_share_interior_names(before, after, seed):
    """Wherever a passage stands, most of its phrases' names are found again."""
    r = np.random.default_rng(seed)
    passage = "".join(r.choice(list("abcdefghij klm"), 3_000))
    inside, other = (set(x) for x, _ in names_of([passage, before + passage + after], 5))
    assert len(inside & other) >= 0.9 * len(inside)


def by_hand(rows):
    """(id, n_chars, edited text) of rows in order."""
    out = []
    for k, (i, text) in enumerate(rows):
        following, n = rows[(k + 1) % len(rows)][1], len(text)
        out.append((i, n, text[: n - n // 4] + following[: n // 4]))
    return out


def found(df, **options):
    got = parsing.edited_fingerprints(df, **options)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return got.collect()


@pytest.mark.parametrize("options", [{}, {"group_bytes": 300}])
def test_sample_against_brute_force(spark, sample, options):
    docs = {r["doc_id"]: r["text"] for r in sample.collect()}
    rows = sorted(docs.items())
    got = {r["doc_id"]: r for r in found(sample, **options)}
    assert len(got) == len(rows)
    prints = {}
    for (i, n, edited), (_, text) in zip(by_hand(rows), rows):
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (edited == text) <= (r["near_edited"] == 1)
    assert len(set(prints.values())) == len(prints)
    for (i, _), (_, text) in zip(rows, rows[1:] + rows[:1]):
        if docs[i] == text:
            assert got[i]["near_next"] == 1


def test_edited_fingerprint_is_that_of_the_edited_text(spark, sample):
    rows = sorted((r["doc_id"], r["text"]) for r in sample.collect())[:40]
    first = {r["doc_id"]: r for r in found(spark.createDataFrame(rows, "doc_id bigint, text string"))}
    again = {r["doc_id"]: r for r in found(spark.createDataFrame([(i, t) for i, _, t in by_hand(rows)], "doc_id bigint, text string"))}
    assert all(first[i]["edited_fingerprint"] == again[i]["fingerprint"] for i, _ in rows)


def test_likeness_tells_edited_from_unrelated(sample):
    """Of documents of 400 code points or more, three quarters kept: like the edited text, unlike the next one."""
    texts = {r["doc_id"]: r["text"] for r in sample.collect()}
    rows = [r for r in found(sample) if r["n_chars"] >= 400]
    brief = [r for r in found(sample) if 50 <= r["n_chars"] < 400]
    assert np.median([r["near_edited"] for r in brief]) > 0.5 and all(r["near_edited"] > r["near_next"] for r in brief)
    edited = np.array([r["near_edited"] for r in rows])
    apart = np.array([r["near_next"] for r in rows if len(set(texts[r["doc_id"]].split()) & set(texts.get(r["doc_id"] + 1, "").split())) < 20])
    assert np.quantile(edited, 0.05) > 0.5 and 0.65 < edited.mean() < 0.85
    assert np.quantile(apart, 0.95) < 0.3 and apart.mean() < 0.1


def test_likeness_estimates_the_share_of_names(spark):
    """Against the exact Dice of the names; 128 places give a standard error of about 0.04."""
    r = np.random.default_rng(3)
    words = ["".join(r.choice(list("abcdefghijklmno"), 6)) for _ in range(3_000)]
    texts = [" ".join(words[a:b]) for a, b in [(0, 800), (200, 1000), (400, 1200), (1100, 1900), (1100, 1900), (2000, 2300)]]
    got = sorted(found(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")))
    sets = [set(n) for n, _ in names_of(texts, 5)]
    for i, row in enumerate(got[:-1]):
        exact = 2 * len(sets[i] & sets[i + 1]) / (len(sets[i]) + len(sets[i + 1]))
        assert abs(row["near_next"] - exact) < 0.12, (i, exact)


@pytest.mark.parametrize("parts", [1, 4])
def test_messy_rows_follow_one_another(spark, messy, parts):
    """Nulls, empty and long texts, repeated rows and ids: rows of one id keep together, by hash of the text."""
    df = messy.withColumnRenamed("part", "edge").withColumnRenamed("key", "hash").repartition(parts)
    order = df.selectExpr("doc_id", "coalesce(text, '') as text", "xxhash64(coalesce(text, '')) as h").collect()
    rows = [(i, t) for i, t, _ in sorted(order, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))]
    want = [(i, n, hashlib.sha256(t.encode()).hexdigest()) for i, n, t in by_hand(rows)]
    got = found(df)
    assert sorted(((r[0], r[1], r[2]) for r in got), key=repr) == sorted(want, key=repr)
    empty = {r["fingerprint"] for r in got if r["n_chars"] == 0}
    assert len(empty) == 1 and empty.isdisjoint(r["fingerprint"] for r in got if r["n_chars"])


def test_single_row_follows_itself(spark):
    [row] = found(spark.createDataFrame([("only", "abcdefgh" * 50)], "doc_id string, text string"))
    assert row["doc_id"] == "only" and row["near_next"] == 1
    assert row["edited_sha256"] == hashlib.sha256(("abcdefgh" * 50)[:300].encode() + ("abcdefgh" * 50)[:100].encode()).hexdigest()


def test_nothing(nothing):
    assert found(nothing) == []
