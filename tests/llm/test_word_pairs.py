"""Operator 4's model of word pairs: its gains against plain Python, and what goes by them."""

from collections import Counter, defaultdict

import numpy as np
import pyspark.sql.functions as F
import pytest
from test_quality import WORD, kind_list, plain_model

from ledgerline.llm import quality


def plain_gains(rows):
    """(lang, text) -> mean gain of its word pairs, from distinct (lang, text) with dictionaries."""
    p = plain_model([t for _, t in rows])

    def spelt(text):
        k, ends, out = [0] * 3 + kind_list(text), [len(x.encode()) for x in text], []
        bits = np.append(0, np.cumsum([-np.log2(p(tuple(k[i : i + 4]))) for i in range(len(k) - 3)]))
        at = np.append(0, np.cumsum(ends))
        for m in WORD.finditer(text):
            out.append((m.group(), bits[at[m.end()]] - bits[at[m.start()]]))
        return out

    found = {(g, t): spelt(t) for g, t in {(g, t) for g, t in rows if t} if len(WORD.findall(t)) >= quality.MIN_WORDS}
    total, count = Counter(), defaultdict(Counter)
    for (g, _), w in found.items():
        total[g] += len(w) - 1
        count[g].update((a, b) for (a, _), (b, _) in zip(w, w[1:], strict=False))
    out = {}
    for (g, t), w in found.items():
        own = Counter((a, b) for (a, _), (b, _) in zip(w, w[1:], strict=False))
        other = max(total[g] - (len(w) - 1), 1)
        gains, first = [], {}
        for (a, x), (b, y) in zip(w, w[1:], strict=False):
            c, (x, y) = count[g][a, b] - own[a, b], first.setdefault((a, b), (x, y))  # noqa: PLW2901
            gains.append(np.log2(c / other * 2 ** (x + y) + 1) - 1 if c else -1)
        out[g, t] = np.mean(gains)
    return out


def test_gains_against_plain_python(spark, sample):
    given = sample.select("doc_id", "text", "lang").where("length(text) < 3000")
    no_lang = given.where("doc_id % 5 = 0").select("doc_id", "text", F.lit(None).cast("string").alias("lang"))
    docs = given.union(no_lang).union(given.where("doc_id % 7 = 0"))
    rows = docs.collect()
    want = plain_gains([(r["lang"], r["text"]) for r in rows])
    assert max(want.values()) > 0
    lang = {(r["doc_id"], r["lang"]): (r["lang"], r["text"]) for r in rows}
    got = quality.quality_rules(docs.withColumn("doc_id", F.struct("doc_id", "lang"))).collect()
    assert len(got) == len(rows)
    for r in got:
        key = lang[tuple(r["doc_id"])]
        if r["n_words"] < quality.MIN_WORDS:
            assert r["word_gain"] is None and key not in want
        else:
            assert r["word_gain"] == pytest.approx(want[key], abs=0.06)  # spelling is dealt in half bits


def test_gains_do_not_hang_on_parts_and_groups(spark, sample):
    docs = sample.select("text", "lang")
    model = quality.kneser_ney(quality.gram_counts(docs))
    scores = quality.measured(docs.withColumn("doc_id", F.lit(1)), model, "doc_id", "text", "lang").persist()
    gains = [
        {tuple(r) for r in quality.word_gains(docs, scores, model, quality.Scratch(spark, "parts"), "text", "lang", rounds, size).collect()}
        for rounds, size in ((1, 4 << 20), (3, 20_000))
    ]
    assert gains[0] == gains[1] and gains[0]


def test_texts_of_another_language_go(spark):
    """Two languages spell their words alike, so that the byte model can't tell them apart; their word pairs can."""
    rng = np.random.default_rng(5)
    made = lambda: ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 7))) for _ in range(100)]
    known = {g: made() for g in ("aa", "bb")}
    text = lambda g: " ".join(rng.choice(known[g], 120))
    rows = [(i, text(g), g) for i, g in enumerate(["aa", "bb"] * 120)]
    rows += [(1000 + i, text("bb"), "aa") for i in range(20)] + [(2000 + i, text("aa"), None) for i in range(3)]
    got = {r["doc_id"]: r for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not any(got[1000 + i]["kept"] or got[1000 + i]["base_failed"] for i in range(20))
    assert np.mean([got[i]["kept"] for i in range(240)]) > 0.95
    assert all(got[2000 + i]["kept"] for i in range(3))  # too few texts for a bound of gains


def test_answers_do_not_name_texts_again(spark):
    """What buckets send back for a text is its number in its chunk and a sum; a text's sum is the same from one bucket as from many,
    and copies in two chunks count once."""
    rng = np.random.default_rng(9)
    texts = [" ".join(rng.choice(["ab", "cd", "ef", "gh", "ij", "kl"], n)) for n in (60, 700, 60, 90)]
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    owners = np.array([11, 22, 11 << 40, 33])
    sums = []
    for size in (1, 9):
        total, rows = Counter(), []
        for k, some in enumerate(([0, 1], [2, 3, 1])):
            flat, ends = np.concatenate([data[i] for i in some]), np.cumsum([0, *(len(data[i]) for i in some)])
            salts, totals = np.zeros(len(some), np.uint64), np.full(len(some), 2000)
            batch = quality.deal_pairs(flat, ends, np.full(len(flat), -3.0), owners[some], salts, totals, np.arange(size, dtype=np.int32), 0, 1, k)
            assert batch.num_rows <= size + 1
            rows += batch.to_pylist()
        table = {r["chunk"]: np.frombuffer(r["owners"], "<i8") for r in rows if r["rows"]}
        for bucket in range(size):
            mine = [r for r in rows if r["bucket"] == bucket and not r["rows"]]
            if not mine:
                continue
            for r, (at, steps) in zip(mine, quality.pair_gains([[r[c] for c in quality._DEALT[3:]] for r in mine]), strict=True):
                assert len(at) <= 2 * len(r["runs"]) and len(steps) <= 4 * len(r["runs"])
                for i, x in zip(np.frombuffer(at, "<u2"), np.frombuffer(steps, "<i4"), strict=True):
                    total[int(table[r["chunk"]][i])] += int(x)
        sums.append(total)
    assert sums[0] == sums[1] and set(sums[0]) == set(owners.tolist())
