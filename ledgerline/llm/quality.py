"""Operator 4: quality rules, the last of them an n-gram perplexity with language-specific bands.

The model is a modified Kneser-Ney model of order 4 over the bytes of the texts, each byte standing for one of
``KINDS`` kinds (single lower-case letters; classes of capitals, digits, signs and bytes of other alphabets).  So
there are at most KINDS^4 = 2,560,000 different n-grams, however large the corpus is; Spark counts them over all
documents.  The probabilities and back-off weights are worked out from these counts and kept, order by order, in
arrays sorted by the hash of the n-gram, which the tasks search.

A document's perplexity is 2^x with x the mean number of bits per byte.  For each language, x has a lower and an
upper bound: ``BAND`` interquartile ranges below the first and above the third quartile of the distinct texts that
pass the base rules.  Below lies text that repeats itself, above text that is no language.  A quartile further from
the median than ``FAR`` times the median distance lies in junk, and is moved there; so junk of nearly half of a
language's texts does not widen its band.  ``BAND`` is the least half at which no more than one in a thousand of the
labelled, not held-out documents of quality 1 that pass the base rules goes (sf0.1: 2 of 2,144).

A second model counts all pairs of neighbouring words, for each language apart, so it grows with the corpus.  Copies of
a text count once.  A pair has the probability 1/2 c / T + 1/2 2^-x, with c of the T pairs in the language's other
texts, the text's own left out, and x the bits in which the byte model spells both words where the text first has them.  A text's ``word_gain`` is
the mean over its pairs of x + log2 of this: how many bits the language's pairs save against spelling, -1 where none is
known.  Pairs are dealt by hash into buckets, sorted and counted there, and only sums by text come back; nothing of
this model is broadcast.  It is done in ``ROUNDS`` parts of the hash space, one after the other, since the dealt pairs
of all texts are larger than the texts.  A text's gain has a lower bound alone (near copies know each other's pairs):
``GAIN_BAND`` median distances below the median of its language's distinct texts that pass the base rules, where there
are ``LEAST_TEXTS`` of them.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ledgerline.llm.shared import Scratch, bucket_names
from ledgerline.llm.textbytes import BLANKS, flat, hashes, mix, runs, table, words
from ledgerline.llm.tokens import by_bytes

KINDS, ORDER = 40, 4
MIN_WORDS, MAX_REPEAT_PERCENT, BAND = 50, 50, 3.5
FAR, LEAST_TEXTS = 1.5, 50
GAIN_BAND, ROUNDS = 3.5, 2
#: Texts of a group at most, whose numbers fit into 16 bits, and pairs of a run at most.
MOST_TEXTS, LONGEST = 1 << 16, 255
#: Steps of a bit in which gains are summed, as whole numbers, so that sums don't hang on the order of rows; and steps
#: in which a pair's bits of spelling less log2 T are dealt, from LEAST_RATIO up.
GAIN_STEPS, RATIO_STEPS, LEAST_RATIO = 1024, 2, -32
SYMBOLS = b"#*$%&|<>"
#: 0 blanks, 1-26 letters, 27-29 capitals, 30 digits, 31 signs of sentences, 32 others, 33 symbols, 34 first bytes
#: of longer characters, 35-39 their other bytes.
_KIND = table(
    {0: bytes(range(0x21)), 30: b"0123456789", 31: b".,;:'\"()-", 33: SYMBOLS, 34: bytes(range(0xC0, 0x100))}
    | {1 + i: bytes([0x61 + i]) for i in range(26)}
    | {27 + i: bytes(range(0x41 + i, 0x5B, 3)) for i in range(3)}
    | {35 + i: bytes(range(0x80 + i, 0xC0, 5)) for i in range(5)},
    32,
)
_IS_SYMBOL = table({1: SYMBOLS}, 0).astype(bool)
_LINES = table({0: b"\n"}, 1)
_IN_WORD = table({0: BLANKS}, 1).astype(bool)


def gram_codes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each byte the number of the n-gram that ends there; before a text stand blanks."""
    kind = _KIND[data].astype(np.int32)
    starts = ends[:-1][ends[:-1] < len(data)]
    code, before = kind.copy(), kind
    for k in range(1, ORDER):
        shifted = np.empty_like(before)
        shifted[1:] = before[:-1]
        shifted[starts] = 0
        before = shifted
        code += before * np.int32(KINDS**k)
    return code


def gram_counts(docs: DataFrame, text_col: str = "text", group_bytes: int = 4 << 20) -> np.ndarray:
    """How often each n-gram occurs in all documents; an array of KINDS^ORDER numbers."""

    def count(batches):
        total = np.zeros(KINDS**ORDER, np.int64)
        for batch in batches:
            texts = batch.column(0)
            for a, b in by_bytes(pc.binary_length(texts).to_pylist(), group_bytes):
                total += np.bincount(gram_codes(*flat(texts.slice(a, b - a))), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["gram", "n"])

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = texts.mapInArrow(count, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(KINDS**ORDER, np.int64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return out


@dataclass
class KneserNey:
    """By order 1 to n: sorted hashes of n-grams and log2 of their probabilities; by order 2 to n: sorted hashes of
    contexts and log2 of their back-off weights."""

    keys: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    floor: float

    @staticmethod
    def key(codes: np.ndarray, order: int) -> np.ndarray:
        return mix(codes.astype(np.uint64) * np.uint64(8) + np.uint64(order))

    @staticmethod
    def _find(keys: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        return at, keys[at] == want

    def log2(self, codes: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Of n-grams of one order: log2 of the last kind's probability after the others."""
        if not order or not len(self.keys[order - 1]):
            return np.full(len(codes), self.floor)
        at, seen = self._find(self.keys[order - 1], self.key(codes, order))
        out = self.logs[order - 1][at].astype(np.float64)
        if not seen.all():
            rest = codes[~seen]
            lower = self.log2(rest % KINDS ** (order - 1), order - 1)
            if order > 1:
                ctx, known = self._find(self.contexts[order - 2], self.key(rest // KINDS, order - 1))
                lower += np.where(known, self.weights[order - 2][ctx], 0)
            out[~seen] = lower
        return out


def _discounts(counts: np.ndarray) -> np.ndarray:
    """The modified discounts of counts 1, 2, and 3 or more; at index 0 that of no count."""
    n = [int((counts == k).sum()) for k in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    found = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * 0.5 for k in (1, 2, 3)]
    return np.array([0, *(min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1))])


def kneser_ney(counts: np.ndarray) -> KneserNey:
    """The model of counts of all n-grams of order ORDER; lower orders count the kinds that come before."""
    levels = [counts.reshape((KINDS,) * ORDER)]
    while levels[0].ndim > 1:
        levels.insert(0, (levels[0] > 0).sum(axis=0))
    below = np.full((), 1 / KINDS)
    keys, logs, contexts, weights = [], [], [], []
    for order, c in enumerate(levels, 1):
        total = c.sum(axis=-1, keepdims=True)
        cut = _discounts(c[c > 0])[np.minimum(c, 3)]
        left = np.where(total > 0, cut.sum(axis=-1, keepdims=True) / np.maximum(total, 1), 1.0)
        p = np.where(total > 0, (c - cut) / np.maximum(total, 1), 0.0) + left * below
        if order > 1:
            ctx = np.flatnonzero(total)
            key = KneserNey.key(ctx, order - 1)
            sort = np.argsort(key)
            contexts.append(key[sort])
            weights.append(np.log2(left.reshape(-1)[ctx][sort]).astype(np.float32))
        codes = np.flatnonzero(c)
        key = KneserNey.key(codes, order)
        sort = np.argsort(key)
        keys.append(key[sort])
        logs.append(np.log2(p.reshape(-1)[codes][sort]).astype(np.float32))
        below = p
    return KneserNey(keys, logs, contexts, weights, float(np.log2(1 / KINDS)))


def meet(known: np.ndarray, model: KneserNey, codes: np.ndarray) -> None:
    """Puts the model's answers for n-grams that were not met before into ``known``."""
    met = np.bincount(codes, minlength=len(known)) > 0
    new = np.flatnonzero(met & np.isnan(known))
    known[new] = model.log2(new)


def measures(data: np.ndarray, ends: np.ndarray, log2: np.ndarray) -> dict[str, np.ndarray]:
    """Per text: the base numbers and bits, the mean bits per byte (0 for an empty text).

    ``log2`` has the model's answer for each n-gram met so far and NaN for the others.
    """
    n = len(ends) - 1
    doc_of = np.repeat(np.arange(n), np.diff(ends))
    count = lambda flags: np.bincount(doc_of[flags], minlength=n)
    out = {"word_chars": count(_IN_WORD[data] & ((data & 0xC0) != 0x80)), "n_symbols": count(_IS_SYMBOL[data])}
    out["bits"] = -np.bincount(doc_of, log2[gram_codes(data, ends)], n) / np.maximum(np.diff(ends), 1)

    start, stop, doc = words(data, ends)
    out["n_words"] = np.bincount(doc, minlength=n)
    word = hashes(data, start, stop)
    out["n_repeat_words"] = np.zeros(n, np.int64)
    if len(word) >= 3:
        three = mix(mix(word[:-2]) + word[1:-1] * np.uint64(3)) + mix(word[2:] + np.uint64(7))
        three = mix(three + doc[2:].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        inside = np.flatnonzero(doc[2:] == doc[:-2])
        again = np.zeros(len(word), bool)
        for k in range(3):
            again[inside[_not_alone(three[inside])] + k] = True
        out["n_repeat_words"] = np.bincount(doc[again], minlength=n)

    start, stop, doc = runs(_LINES[data], ends)
    if len(start):
        full = np.add.reduceat(_IN_WORD[data], start, dtype=np.int64) > 0  # reduceat runs on to the next line: \n is no word
        start, stop, doc = start[full], stop[full], doc[full]
    line = mix(hashes(data, start, stop) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(line, return_index=True)
    out["n_dup_lines"] = np.bincount(doc, minlength=n) - np.bincount(doc[first], minlength=n)
    return out


def _not_alone(x: np.ndarray) -> np.ndarray:
    """Whether another element has the same value."""
    order = np.argsort(x, kind="stable")
    same = x[order[1:]] == x[order[:-1]]
    out = np.zeros(len(x), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, model: KneserNey, id_col: str, text_col: str, lang_col: str, group_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, lang, text_key (a hash of lang and text), the base numbers, bits, base_failed."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 12 bytes for each of the n-grams of all orders

    def run(batches):
        known = np.full(KINDS**ORDER, np.nan)
        for batch in batches:
            texts = batch.column(2)
            for a, b in by_bytes(pc.binary_length(texts).to_pylist(), group_bytes):
                data, ends = flat(texts.slice(a, b - a))
                meet(known, shared.value, gram_codes(data, ends))
                found = measures(data, ends, known)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, b - a) for c in (0, 1, 3)), *(pa.array(found[c].astype(np.int64)) for c in BASE), pa.array(found["bits"])],
                    names=["doc_id", "lang", "text_key", *BASE, "bits"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("lang", "text"))
    out = rows.mapInArrow(run, f"doc_id {kind}, lang string, text_key bigint, {', '.join(f'{c} bigint' for c in BASE)}, bits double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def bands(scores: DataFrame, width: float = BAND) -> DataFrame:
    """By language (null is one of its own) the least and the greatest bits of documents that stay.

    Copies of a text count once.  The median distance is taken from ``LEAST_TEXTS`` texts on.
    """
    quarter = lambda q, x="bits": F.percentile_approx(x, q, 10_000)
    once = scores.where("not base_failed").groupBy("lang", "text_key").agg(F.min("bits").alias("bits"))
    found = once.groupBy(F.col("lang").alias("band_lang")).agg(
        F.count("*").alias("n_texts"), quarter(0.25).alias("q1"), quarter(0.5).alias("mid"), quarter(0.75).alias("q3")
    )
    apart = once.join(found, F.col("lang").eqNullSafe(F.col("band_lang"))).withColumn("apart", F.abs(F.col("bits") - F.col("mid")))
    found = apart.groupBy("band_lang").agg(*(F.first(c).alias(c) for c in ("n_texts", "q1", "mid", "q3")), quarter(0.5, "apart").alias("apart"))
    far = F.when(F.col("n_texts") >= LEAST_TEXTS, F.col("apart") * FAR)  # null, which greatest and least pass over, for few texts
    found = found.withColumn("q1", F.greatest("q1", F.col("mid") - far)).withColumn("q3", F.least("q3", F.col("mid") + far))
    spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(0.02)) * width
    return found.select("band_lang", (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high"))


_DEALT = ["bucket", "chunk", "rows", "pairs", "ratios", "counts", "owners", "at", "runs"]
_DEALT_KIND = "bucket int, chunk bigint, rows int, pairs binary, ratios binary, counts binary, owners binary, at binary, runs binary"


def deal_pairs(data, ends, log2, owners, salts, totals, buckets, part: int, rounds: int, salt: int = 0) -> pa.RecordBatch | None:
    """The word pairs of texts in one part of the hash space, one row per bucket: 40 bits of each distinct pair of a text,
    bits of spelling less log2 of the language's other pairs, how often the text has it; 40 bits of the texts, which tell
    copies, their numbers in the chunk that the given texts are, and how many pairs follow.

    The last row is the chunk's table: how many rows it dealt, and its texts.  Texts with fewer than MIN_WORDS words and
    all but the first copy of a text are passed over.
    """
    start, stop, doc = words(data, ends)
    n_words = np.bincount(doc, minlength=len(owners))
    used = np.zeros(len(owners), bool)
    used[np.unique(owners, return_index=True)[1]] = True
    at = np.flatnonzero((doc[1:] == doc[:-1]) & (used & (n_words >= MIN_WORDS))[doc[1:]])
    word = hashes(data, start, stop)
    key = mix(mix(word[at] ^ salts[doc[at]]) * np.uint64(0x9E3779B97F4A7C15) + word[at + 1])
    mine = (key >> np.uint64(56)) % np.uint64(rounds) == part
    key, at = key[mine], at[mine]
    if not len(at):
        return None
    spelt = np.append(0, np.cumsum(log2))
    spelt = (spelt[start] - spelt[stop])[at] + (spelt[start] - spelt[stop])[at + 1]
    ratio = spelt - np.log2(np.maximum(totals - (n_words - 1), 1))[doc[at]]
    ratio = np.clip(np.rint((ratio - LEAST_RATIO) * RATIO_STEPS), 0, 255).astype(np.uint8)
    run = ((key >> np.uint64(40)) & np.uint64(0xFFFF)).astype(np.int64) % len(buckets) * len(owners) + doc[at]
    order = np.lexsort((key, run))
    key, run, ratio = key[order], run[order], ratio[order]
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (run[1:] != run[:-1])])
    count = np.diff(np.append(first, len(key))).astype("<u4")
    low, run, ratio = key[first].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5], run[first], ratio[first]
    bucket = run // len(owners)
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
    texts, number = np.unique(run % len(owners), return_inverse=True)
    digest = mix(owners.view(np.uint64))
    with np.errstate(over="ignore"):
        place = np.arange(1, 2 * len(owners), 2, np.uint64)
        chunk = int(((digest * place).sum(dtype=np.uint64) + np.uint64(salt) * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64))
    brief = digest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    rows = []
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        change = np.r_[True, run[x + 1 : y] != run[x : y - 1], True]
        change[::LONGEST] = True
        new = np.flatnonzero(change)
        at = number[x:y][new[:-1]]
        parts = (low[x:y], ratio[x:y], count[x:y], brief[texts[at]], at.astype("<u2"), np.diff(new).astype(np.uint8))
        rows.append((int(buckets[bucket[x]]), chunk, 0, *(p.tobytes() for p in parts)))
    rows.append((int(buckets[chunk % len(buckets)]), chunk, len(rows), b"", b"", b"", owners[texts].astype("<i8").tobytes(), b"", b""))
    kinds = (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 6)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=_DEALT)


def pair_gains(parts: list) -> list[tuple[bytes, bytes]]:
    """Of the rows of one bucket, from pairs on: for each row its texts' numbers and the sums of their pairs' gains in steps."""
    kinds = (np.uint8, np.uint8, "<u4", np.uint8, "<u2", np.uint8)
    low, ratio, count, owner, at, runs_ = (np.frombuffer(b"".join(p[k] for p in parts), t) for k, t in enumerate(kinds))
    wide = np.zeros((2, max(len(low), len(owner)) // 5, 8), np.uint8)
    wide[0, : len(low) // 5, :5], wide[1, : len(owner) // 5, :5] = low.reshape(-1, 5), owner.reshape(-1, 5)
    key, run = wide[0].view("<u8")[: len(low) // 5, 0], np.repeat(np.arange(len(runs_)), runs_)
    owner = wide[1].view("<u8")[run, 0]
    order = np.lexsort((owner, key))
    key, owner = key[order], owner[order]
    first = np.r_[True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])]  # copies of a text count once
    key, order = key[first], order[first]
    count = count[order].astype(np.int64)
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    others = np.repeat(np.add.reduceat(count, starts), np.diff(np.append(starts, len(key)))) - count
    gain = np.full(len(key), -GAIN_STEPS, np.int64)
    seen = np.flatnonzero(others)
    bits = np.log2(others[seen] * np.exp2(ratio[order[seen]] / RATIO_STEPS + LEAST_RATIO) + 1) - 1
    gain[seen] = np.rint(bits * GAIN_STEPS)
    total = np.bincount(run[order], gain * count, len(runs_)).astype(np.int64)  # exact below 2^53
    ends = np.cumsum([0, *(len(p[5]) for p in parts)])
    out = []
    for x, y in zip(ends[:-1], ends[1:], strict=True):
        some = x + np.flatnonzero(total[x:y])
        sums = total[some]
        small = not len(sums) or np.abs(sums).max() < 1 << 31
        out.append((at[some].tobytes(), sums.astype("<i4" if small else "<i8").tobytes()))
    return out


def word_gains(docs: DataFrame, scores: DataFrame, model: KneserNey, scratch: Scratch, text_col: str, lang_col: str, rounds: int = ROUNDS, group_bytes: int = 4 << 20) -> DataFrame:
    """text_key and word_gain of all texts of at least MIN_WORDS words."""
    once = scores.where(F.col("n_words") >= MIN_WORDS).groupBy("lang", "text_key").agg((F.min("n_words") - 1).alias("pairs"))
    totals = scratch.write(once.groupBy(F.col("lang").alias("total_lang")).agg(F.sum("pairs").alias("total")), "totals")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    buckets = bucket_names(docs.sparkSession)
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.join(totals, F.col("lang").eqNullSafe(F.col("total_lang")))
    texts = texts.select("text", F.xxhash64("lang", "text").alias("owner"), F.xxhash64("lang").alias("salt"), "total")

    def deal(part):
        def run(batches):
            known = np.full(KINDS**ORDER, np.nan)
            salt = TaskContext.get().partitionId() << 32
            for batch in batches:
                spans = by_bytes(pc.binary_length(batch.column(0)).to_pylist(), group_bytes)
                for a, b in ((k, min(k + MOST_TEXTS, b)) for a, b in spans for k in range(a, b, MOST_TEXTS)):
                    salt += 1
                    data, ends = flat(batch.column(0).slice(a, b - a))
                    codes = gram_codes(data, ends)
                    meet(known, shared.value, codes)
                    owners, salts, totals_ = (batch.column(c).slice(a, b - a).to_numpy() for c in (1, 2, 3))
                    if (out := deal_pairs(data, ends, known[codes], owners, salts.view(np.uint64), totals_, buckets, part, rounds, salt)) is not None:
                        yield out

        return run

    def count(batches):
        by_bucket: dict[int, list] = {}
        for batch in batches:
            for bucket, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                by_bucket.setdefault(bucket, []).append(rest)
        while by_bucket:
            _, found = by_bucket.popitem()
            parts = [p for p in found if not p[1]]
            rows = [(p[0], 0, b"", *x) for p, x in zip(parts, pair_gains([p[2:] for p in parts]) if parts else [], strict=True)]
            rows += [(p[0], p[1], p[5], b"", b"") for p in found if p[1]]
            kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 3)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["chunk", "rows", "owners", "at", "sums"])

    def gather(batches):
        by_chunk: dict[int, list] = {}
        for batch in batches:
            for chunk, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                by_chunk.setdefault(chunk, []).append(rest)
        while by_chunk:
            _, found = by_chunk.popitem()
            tables, answers = [x for x in found if x[0]], [x for x in found if not x[0]]
            if sum(x[0] for x in tables) != len(answers):
                raise RuntimeError("a group of texts was dealt twice, in different orders")
            owner = np.frombuffer(tables[0][1], "<i8")
            at = np.concatenate([np.frombuffer(x[2], "<u2") for x in answers])
            total = np.concatenate([np.frombuffer(x[3], "<i4" if len(x[3]) == 2 * len(x[2]) else "<i8").astype(np.int64) for x in answers])
            steps = np.bincount(at, total, len(owner)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(steps)], names=["text_key", "steps"])

    def sums(part):
        dealt = texts.mapInArrow(deal(part), _DEALT_KIND).repartition("bucket")
        answers = dealt.mapInArrow(count, "chunk bigint, rows int, owners binary, at binary, sums binary")
        return answers.repartition("chunk").mapInArrow(gather, "text_key bigint, steps bigint")

    done = []
    for part in range(rounds):
        done.append(scratch.write(sums(part), f"gains-{part}"))
        scratch.release()  # the part's frames are gone now, so the next one finds its disk free
    steps = functools.reduce(DataFrame.unionByName, done).groupBy("text_key").agg(F.sum("steps").alias("steps"))
    return once.join(steps, "text_key").select("text_key", (F.col("steps") / F.col("pairs") / GAIN_STEPS).alias("word_gain"))


def gain_bands(scores: DataFrame, width: float = GAIN_BAND) -> DataFrame:
    """By language (null is one of its own) the least word_gain of documents that stay; copies of a text count once."""
    middle = lambda x: F.percentile_approx(x, 0.5, 10_000)
    once = scores.where("not base_failed").groupBy("lang", "text_key").agg(F.min("word_gain").alias("gain"))
    found = once.groupBy(F.col("lang").alias("gain_lang")).agg(F.count("*").alias("n_texts"), middle("gain").alias("mid"))
    apart = once.join(found.where(F.col("n_texts") >= LEAST_TEXTS), F.col("lang").eqNullSafe(F.col("gain_lang")))
    spread = F.greatest(middle(F.abs(F.col("gain") - F.col("mid"))), F.lit(0.02)) * width
    return apart.groupBy("gain_lang").agg((F.first("mid") - spread).alias("least_gain"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", width: float = BAND) -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, bits, word_gain.

    A null text has no words and fails the base rules.  Rows without a language share a band.  Null ids stay,
    equal rows give equal rows, other columns aren't read, and an empty table gives an empty result.  A language
    none of whose documents passes the base rules has no band, and none of its documents is kept.
    """
    model = kneser_ney(gram_counts(docs, text_col))
    scratch = Scratch(docs.sparkSession, "quality")
    scores = scratch.write(measured(docs, model, id_col, text_col, lang_col), "scores")
    gains = word_gains(docs, scores, model, scratch, text_col, lang_col)
    scores = scratch.write(scores.join(gains, "text_key", "left"), "gained")
    joined = scores.join(bands(scores, width), F.col("lang").eqNullSafe(F.col("band_lang")), "left")
    joined = joined.join(gain_bands(scores), F.col("lang").eqNullSafe(F.col("gain_lang")), "left")
    inside = F.coalesce(F.col("bits").between(F.col("low"), F.col("high")), F.lit(False))
    known = F.coalesce(F.col("word_gain") >= F.col("least_gain"), F.lit(True))
    return joined.select(F.col("doc_id").alias(id_col), *BASE, "base_failed", (~F.col("base_failed") & inside & known).alias("kept"), "bits", "word_gain")
