"""Operator 13: runs of words that repeat with a period, by internal pattern matching.

The words of a document stand in a suffix array, sorted by doubling, so that all occurrences of a block of 2, 4, 8, ...
words are one interval of it.  A wavelet tree over the array answers the range-successor query "the next occurrence of
this block after (before) here".  Blocks are dyadic: one of 2^k words starts at each multiple of 2^k.  A block asks for
its occurrences in the windows of 2^k words on either side.  Those within a run form a progression, and the
distance to the nearest one is its period.

Why no run is missed: let a run have smallest period q and length >= 4q, and let 2^k be the least power of two with
2^k >= q (at least 2).  Then 2^k < 2q, so some block of 2^k words at a multiple of 2^k lies inside the run, and the run holds a
copy of the block q words after or before it.  No copy lies nearer within the run: a block as long as the period fits
a primitive period at its multiples only.  So each candidate distance of level k is in (2^(k-1), 2^k], a candidate's
stretch is the longest around it that keeps the distance, and a stretch of four periods has no smaller one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from ledgerline.llm import textbytes

BLANK = ord(" ")
RUN = "start: bigint, length: bigint, period: bigint"


class SuffixBlocks:
    """Suffix array of many documents' words, and the interval of each dyadic block that occurs twice in its document.

    ``sa`` is sorted by document, then by words as far as blocks can tell suffixes apart.  ``blocks`` has, for each level,
    the level, the first words of its blocks, and the intervals of ``sa`` that hold a block's occurrences.
    """

    def __init__(self, codes: np.ndarray, ends: np.ndarray):
        n, sizes = len(codes), np.diff(ends)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        stop, place = ends[1:][doc], np.arange(n) - ends[:-1][doc]
        most = int(codes.max()) + 1 if n else 1
        follow = np.zeros(n, np.int64)
        follow[:-1] = codes[1:] + 1
        follow[ends[1:][sizes > 0] - 1] = 0
        key = (doc * most + codes) * (most + 1) + follow
        self.sa = np.argsort(key)
        self.blocks: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        rank = np.empty(n, np.int64)
        slots, members = np.arange(n), self.sa
        key, level, longest = key[members], 1, int(sizes.max()) if len(sizes) else 0
        while True:
            first = np.empty(len(key), bool)
            first[:1] = True
            np.not_equal(key[1:], key[:-1], out=first[1:])
            at = np.flatnonzero(first)
            size = np.diff(np.append(at, len(key)))
            low = np.repeat(slots[at], size)
            rank[members] = low
            twice = np.repeat(size > 1, size)
            members, slots, low, size = members[twice], slots[twice], low[twice], np.repeat(size, size)[twice]
            if level == 1:
                self.repeated, self.slots = members, slots
            start = place[members] % (1 << level) == 0
            if start.any():
                self.blocks.append((level, members[start], low[start], low[start] + size[start]))
            if not len(members) or 2 << level >= longest:  # a period has at most a fourth of the words
                break
            after = members + (1 << level)
            second = np.where(after < stop[members], rank[np.minimum(after, n - 1)] + 1, 0)
            key = low * (n + 1) + second
            order = np.argsort(key)
            members, key = members[order], key[order]
            self.sa[slots] = members
            level += 1


class WaveletTree:
    """Bit by bit counts of a sequence of numbers, answering rank and quantile of many intervals at once."""

    def __init__(self, values: np.ndarray):
        self.levels: list[tuple[np.ndarray, int]] = []
        self.bits = max(1, int(len(values) - 1).bit_length())
        for b in range(self.bits - 1, -1, -1):
            ones = (values >> b) & 1 == 1
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~ones, out=zeros[1:])
            self.levels.append((zeros, int(zeros[-1])))
            values = np.concatenate([values[~ones], values[ones]])

    def rank(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many numbers in [low, high) are less than the value."""
        found = np.zeros(len(low), np.int64)
        for b, (zeros, total) in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            z, y = zeros[low], zeros[high]
            one = (value >> b) & 1 == 1
            found += np.where(one, y - z, 0)
            low, high = np.where(one, total + low - z, z), np.where(one, total + high - y, y)
        return found

    def quantile(self, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The number at a place (from 0) of the sorted numbers in [low, high)."""
        found, place = np.zeros(len(low), np.int64), place.copy()
        for b, (zeros, total) in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            z, y = zeros[low], zeros[high]
            one = place >= y - z
            found += np.where(one, 1 << b, 0)
            place -= np.where(one, y - z, 0)
            low, high = np.where(one, total + low - z, z), np.where(one, total + high - y, y)
        return found


def candidates(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and distances: the block there occurs again at the distance, and nowhere nearer."""
    suffixes = SuffixBlocks(codes, ends)
    if not suffixes.blocks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Only suffixes whose first two words repeat are in the tree; slots and positions are renumbered to match.
    held = np.zeros(len(codes) + 1, np.int64)
    held[suffixes.slots + 1] = 1
    slot = np.cumsum(held)
    positions = np.sort(suffixes.repeated)
    number = np.empty(len(codes), np.int64)
    number[positions] = np.arange(len(positions))
    tree = WaveletTree(number[suffixes.sa[suffixes.slots]])
    level = np.concatenate([np.full(len(b[1]), b[0]) for b in suffixes.blocks])
    block, low, high = (np.concatenate([b[i] for b in suffixes.blocks]) for i in (1, 2, 3))
    low, high = slot[low], slot[high]
    own = tree.rank(low, high, number[block])
    at, distance = [], []
    for step in (1, -1):
        there = (own + step >= 0) & (own + step < high - low)
        other = positions[tree.quantile(low[there], high[there], own[there] + step)]
        gap, k = np.abs(other - block[there]), level[there]
        near = (gap <= 1 << k) & ((gap > 1 << (k - 1)) | (k == 1))
        at.append(np.minimum(other, block[there])[near])
        distance.append(gap[near])
    return np.concatenate(at), np.concatenate(distance)


def _agreeing(codes: np.ndarray, at: int, period: int, most: int, step: int) -> int:
    """How many words from ``at`` on (or back) equal those a period further on, at most ``most``."""
    done, size = 0, 64
    while done < most:
        n = min(size, most - done)
        x = at + done if step > 0 else at - done - n + 1
        differ = codes[x : x + n] != codes[x + period : x + period + n]
        if differ.any():
            return done + int(np.argmax(differ if step > 0 else differ[::-1]))
        done, size = done + n, size * 2
    return done


def find_runs(codes: np.ndarray, ends: np.ndarray, least: int = 6, exponent: int = 4) -> np.ndarray:
    """Rows (first word, length, smallest period), by first word and period, of all runs in all documents.

    Document d has the words ``codes[ends[d]:ends[d + 1]]``.  A run is as long as it can be, has at least ``least`` words
    and ``exponent`` periods; fewer than four periods are no run here, since the search relies on that.
    """
    if exponent < 4:
        raise ValueError("the search finds runs of four periods or more")
    codes, ends = np.asarray(codes, np.int64), np.asarray(ends, np.int64)
    at, period = candidates(codes, ends)
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    doc = np.searchsorted(ends, at, "right") - 1
    runs, i = [], 0
    while i < len(at):
        a, p = int(at[i]), int(period[i])
        begin, end = int(ends[doc[i]]), int(ends[doc[i] + 1])
        right = _agreeing(codes, a, p, end - p - a, 1)
        left = _agreeing(codes, a - 1, p, a - begin, -1)
        length = left + right + p
        if length >= max(least, exponent * p):
            runs.append((a - left, length, p))
        same = int(np.searchsorted(period, p, "right"))
        i += max(1, int(np.searchsorted(at[i:same], a + right)))  # the others within this stretch give the same run
    return np.array(sorted(runs, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _groups(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Rows in a row with at most ``most`` bytes, or one longer text."""
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy())])
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + most, "right")) - 1)
        yield i, j
        i = j


def _collapsed(data: np.ndarray, start: np.ndarray, stop: np.ndarray, kept: np.ndarray, doc: np.ndarray, docs: int) -> pa.Array:
    """The kept words of each document with one blank between them."""
    start, stop, doc = start[kept], stop[kept], doc[kept]
    more = np.append(doc[1:] == doc[:-1], False) if len(doc) else np.zeros(0, bool)
    size = stop - start + more
    offset = np.cumsum(size) - size
    index = np.repeat(start - offset, size) + np.arange(int(size.sum()))
    out = data[np.minimum(index, max(len(data) - 1, 0))]
    out[(offset + size - 1)[more]] = BLANK
    bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, size, docs))]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(docs, pa.py_buffer(bounds), pa.py_buffer(out))


def text_runs(texts: pa.Array, least: int, exponent: int) -> tuple[pa.Array, pa.Array]:
    """The runs of each text as a list of (start, length, period), and the texts without the repeats."""
    data, ends = textbytes.flat(texts)
    start, stop, doc = textbytes.words(data, ends)
    offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int64)
    letters = data[~np.isin(data, np.frombuffer(textbytes.BLANKS, np.uint8))]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    runs = find_runs(codes, first, least, exponent)
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    owner = np.searchsorted(first, runs[:, 0], "right") - 1
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    found = pa.StructArray.from_arrays([pa.array(x) for x in (runs[:, 0] - first[owner], runs[:, 1], runs[:, 2])], ["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(bounds), found), _collapsed(data, start, stop, kept, doc, len(texts))


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 6, exponent: int = 4,
                  group_bytes: int = 2_000_000) -> DataFrame:
    """One row per row of ``docs``: its id, ``runs`` (an array of start, length and period in words, by start and period)
    and ``collapsed``, its words without the repeats of any run, one blank between them.

    Words are runs of anything but blanks, compared as they are.  A null text, an empty one and one of blanks alone have
    no runs and collapse to ''.  Rows are looked at one by one, so repeated rows, ids that are null or the same and other
    columns change nothing; no row leaves its task.  A task works on ``group_bytes`` of text at a time, or one longer text.
    """
    name = docs.select(F.col(id_col)).schema[0]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in _groups(batch.column(1), group_bytes):
                runs, collapsed = text_runs(batch.column(1).slice(i, j - i), least, exponent)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), runs, collapsed.cast(pa.string())], ["id", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = rows.mapInArrow(find, f"id {name.dataType.simpleString()}, runs array<struct<{RUN}>>, collapsed string")
    return found.withColumnRenamed("id", id_col)


def planted(id_: Column, text: Column) -> Column:
    """The text with a stretch of some documents made periodic: from word a on, the p words at a again and again.

    With h the crc32 of the id in decimal and g = h div 10, it happens where 10 divides h: a = g mod n, and
    p = 1 + (n - a) div (3 + g mod 8), n being the number of words.  Other texts, and those without an id, stay.
    """
    h = F.crc32(id_.cast("string").cast("binary"))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")

    def periodic(x: Column) -> Column:  # x: struct of words, n and g
        a = F.pmod(x["g"], x["n"])
        p = 1 + F.floor((x["n"] - a) / (3 + F.pmod(x["g"], F.lit(8))))
        at = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), x["n"] - 1), lambda i: F.get(x["words"], at(i))), " ")

    facts = F.struct(words.alias("words"), F.size(words).cast("long").alias("n"), F.floor(h / 10).alias("g"))
    changed = F.transform(F.array(facts), lambda x: F.when(x["n"] > 0, periodic(x)).otherwise(text))[0]
    return F.when(h % 10 == 0, changed).otherwise(text)


def planted_runs(docs: DataFrame) -> DataFrame:
    """The runs of the planted texts in figures: doc_id, n_runs; start, length, period and exponent_milli of the run with
    the greatest exponent (the first of equal ones, then that of smaller period); digests of all runs and of what is left.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = periodic_runs(docs.select("doc_id", planted(F.col("doc_id"), text).alias("text")))

    def before(x: Column, y: Column) -> Column:
        gain = x["length"] * y["period"] - y["length"] * x["period"]
        return F.when(gain > 0, -1).when(gain < 0, 1).when(x["start"] != y["start"], F.signum(x["start"] - y["start"]).cast("int")).otherwise(
            F.signum(x["period"] - y["period"]).cast("int"))

    best = F.get(F.array_sort("runs", before), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
