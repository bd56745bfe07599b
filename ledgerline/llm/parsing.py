"""Operator 12: document fingerprints by locally consistent parsing.

A text is parsed into phrases, the phrases into phrases of phrases, and so on until one is left.  On each level

1. a run of one symbol becomes one symbol, so that neighbours differ;
2. deterministic coin tossing gives each symbol a label: twice the lowest bit in which it differs from its left
   neighbour, plus that bit of its own.  Neighbours still differ, and from 64 bits four rounds leave six labels;
3. a phrase begins at each local maximum of the labels (and at the start of the text);
4. a phrase is named by a 64-bit hash of its symbols.

Where phrases begin hangs on a few symbols around the place alone, so equal substrings have equal phrases and names in
their interior, at whatever offset they stand.  A fingerprint is a one-permutation MinHash of the set of names of all
phrases of at least ``least_chars`` code points, with the name of the whole text; the likeness of two is the share of
names that both have (Dice), estimated from the places in which they agree.

Texts are dealt out once, by ranges of the id, so that the next document is the next row; only the first and last row
of each partition wait for their neighbours in other partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.window import Window

from ledgerline.llm.shared import Scratch
from ledgerline.llm.textbytes import flat, mix

BINS = 128  # places of a fingerprint, one byte each
_BIN_BITS = BINS.bit_length() - 1
_STEP, _SEED = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_LABELS = 128  # after the first round: a place among 64 bits, and the bit there


def _toss_table() -> np.ndarray:
    """The label of a symbol for each pair of (left neighbour's, own) label."""
    left, own = np.divmod(np.arange(_LABELS * _LABELS), _LABELS)
    differ = left ^ own
    place = np.where(differ == 0, 0, np.bitwise_count((differ & -differ) - 1))
    return (2 * place + ((own >> place) & 1)).astype(np.uint8)


_TOSS = _toss_table()


def labels(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A label of 0 to 5 for each symbol; ``first`` are the places where texts begin, and neighbours in a text differ."""
    left = np.empty_like(symbols)
    left[1:] = symbols[:-1]
    left[first] = symbols[first] ^ np.uint64(1)
    differ = symbols ^ left
    place = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1))
    out = (2 * place + ((symbols >> place.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)).astype(np.uint8)
    before = np.empty(len(out), np.uint16)
    for _ in range(3):
        before[1:] = out[:-1]
        before[first] = out[first] ^ 1
        out = _TOSS[before * np.uint16(_LABELS) + out]
    return out


def _phrases(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where phrases begin."""
    label = labels(symbols, first)
    starts = np.zeros(len(symbols), bool)
    rises = label[1:] > label[:-1]
    starts[1:-1] = rises[:-1] & ~rises[1:]
    last = first[1:] - 1
    starts[last] = False  # the last symbol of a text has no right neighbour
    starts[first] = True
    return np.flatnonzero(starts)


def names(points: np.ndarray, ends: np.ndarray, least_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, text's number) of the phrases with at least ``least_chars`` code points, and the name of each whole text.

    ``points`` are the code points of all texts, one after the other; the name of an empty text is 0.
    """
    text = np.flatnonzero(np.diff(ends))
    first = ends[text]
    whole = np.zeros(len(ends) - 1, np.uint64)
    symbols, covered = points.astype(np.uint64), np.ones(len(points), np.int64)
    found, owner = [], []
    while len(text):
        # Runs of one symbol become one.
        new = np.empty(len(symbols), bool)
        new[0] = True
        np.not_equal(symbols[1:], symbols[:-1], out=new[1:])
        new[first] = True
        if not new.all():
            at = np.flatnonzero(new)
            times = np.diff(np.append(at, len(symbols)))
            symbols, covered = symbols[at], covered[at] * times
            more = times > 1
            symbols[more] = mix(symbols[more] * _STEP + times[more].astype(np.uint64))
            first = np.searchsorted(at, first)
        # Texts of which one symbol is left are done.
        size = np.diff(np.append(first, len(symbols)))
        over = size == 1
        if over.any():
            whole[text[over]] = mix(symbols[first[over]] + _SEED)
            kept = np.repeat(~over, size)
            symbols, covered = symbols[kept], covered[kept]
            text, size = text[~over], size[~over]
            first = np.cumsum(size) - size
            if not len(text):
                break
        at = _phrases(symbols, first)
        place = np.arange(len(symbols)) - np.repeat(at, np.diff(np.append(at, len(symbols))))
        symbols = mix(np.add.reduceat(mix(symbols + _STEP * (place + 1).astype(np.uint64)), at))
        covered = np.add.reduceat(covered, at)
        first = np.searchsorted(at, first)
        long = covered >= least_chars
        found.append(symbols[long])
        owner.append(np.repeat(text, np.diff(np.append(first, len(symbols))))[long])
    none = np.zeros(0, np.int64)
    return np.concatenate(found or [none.astype(np.uint64)]), np.concatenate(owner or [none]), whole


def fingerprints(points: np.ndarray, ends: np.ndarray, least_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Name of each whole text, and its sketch: for each place the least name there, as one byte (0: none)."""
    name, owner, whole = names(points, ends, least_chars)
    full = np.flatnonzero(np.diff(ends))
    h = mix(np.concatenate([name, whole[full]]) ^ _SEED)
    owner = np.concatenate([owner, full])
    least = np.full((len(ends) - 1) * BINS, np.iinfo(np.uint64).max, np.uint64)
    slot = owner * BINS + (h >> np.uint64(64 - _BIN_BITS)).astype(np.int64)
    np.minimum.at(least, slot, h & np.uint64((1 << (64 - _BIN_BITS)) - 1))
    sketch = np.where(least == np.iinfo(np.uint64).max, 0, 1 + least % np.uint64(255)).astype(np.uint8)
    return whole, sketch.reshape(-1, BINS)


def likeness(whole_a: np.ndarray, a: np.ndarray, whole_b: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of names that two texts have in common: 1 for equal texts, 0 where no place agrees."""
    agree = ((a == b) & (a > 0)).sum(1)
    either = ((a > 0) | (b > 0)).sum(1)
    return np.where(whole_a == whole_b, 1.0, 2 * agree / np.maximum(either + agree, 1))


def _points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the texts, where each code point begins (and the end), code points, and where each text begins in them."""
    data, ends = flat(texts)
    lead = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    return data, lead, np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), np.searchsorted(lead, ends)


def compare(texts: pa.Array, least_chars: int) -> list[pa.Array]:
    """For each text but the last: n_chars, edited_sha256, fingerprint and edited_fingerprint as bytes, near_edited, near_next.

    The edited text has the last quarter of its code points replaced by as many of the next text's first ones.
    """
    data, lead, points, ends = _points(texts)
    size = np.diff(ends)
    n = len(texts) - 1
    keep = size[:n] - size[:n] // 4
    take = np.minimum(size[:n] // 4, size[1:])
    total = keep + take
    start = np.cumsum(total) - total
    fresh = np.arange(int(total.sum())) - np.repeat(start, total) >= np.repeat(keep, total)
    index = np.arange(int(total.sum())) + np.repeat(ends[:n] - start, total)
    index[fresh] += np.repeat(ends[1 : n + 1] - ends[:n] - keep, take)
    both = np.concatenate([points, points[index]])
    whole, sketch = fingerprints(both, np.concatenate([ends, ends[-1] + np.cumsum(total)]), least_chars)
    digests = []
    view = memoryview(np.ascontiguousarray(data))
    cuts = (lead[ends[:n]], lead[ends[:n] + keep], lead[ends[1 : n + 1]], lead[ends[1 : n + 1] + take])
    for a, b, c, d in zip(*(x.tolist() for x in cuts), strict=True):
        digest = hashlib.sha256(view[a:b])
        digest.update(view[c:d])
        digests.append(digest.hexdigest())
    prints = np.concatenate([whole.astype(">u8")[:, None].view(np.uint8), sketch], axis=1)
    width = pa.binary(prints.shape[1])
    as_bytes = lambda x: pa.FixedSizeBinaryArray.from_buffers(width, len(x), [None, pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary())
    edited = likeness(whole[:n], sketch[:n], whole[n + 1 :], sketch[n + 1 :])
    following = likeness(whole[:n], sketch[:n], whole[1 : n + 1], sketch[1 : n + 1])
    return [pa.array(size[:n]), pa.array(digests, pa.string()), as_bytes(prints[:n]), as_bytes(prints[n + 1 :]), pa.array(edited), pa.array(following)]


FOUND = "n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_NAMES = [x.split()[0] for x in FOUND.split(", ")]


def _cuts(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes (or one row), leaving out the last row: it follows the last range."""
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy())])
    i = 0
    while i < len(texts) - 1:
        j = min(len(texts) - 1, max(i + 1, int(np.searchsorted(ends, ends[i] + most, "right")) - 1))
        yield i, j
        i = j


def edited_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 5, group_bytes: int = 400_000) -> DataFrame:
    """One row per row of ``docs``: its id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Fingerprints are hexadecimal: 16 digits of the whole text's name and two for each place of the sketch.  A null text
    counts as empty; an empty text is like other empty ones alone.  Rows are ordered by id, those without one first, then by a
    hash of the text and then by place in the input, each row being a document: of repeated rows each is followed by the next.
    The last row is followed by the first, a single one by itself.  Other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    key = ["id", "hash", "place"]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*key).sortWithinPartitions(*key).select("id", "text")

    def compared(ids: pa.Array, texts: pa.Array, part: int) -> Iterator[pa.RecordBatch]:
        for i, j in _cuts(texts, group_bytes):
            n = j - i
            found = compare(texts.slice(i, n + 1), least_chars)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array([0] * n, pa.int32()), ids.slice(i, n), pa.nulls(n, pa.string()), *found],
                ["part", "edge", "id", "text", *_NAMES],
            )

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, texts = TaskContext.get().partitionId(), None, None

        def edge(which: int, at: int) -> pa.RecordBatch:
            given = [pa.array([part], pa.int32()), pa.array([which], pa.int32()), ids.slice(at, 1), texts.slice(at, 1)]
            empty = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([*given, *empty], ["part", "edge", "id", "text", *_NAMES])

        for batch in batches:
            if not batch.num_rows:
                continue
            if ids is None:
                ids, texts = batch.column(0), batch.column(1)
                yield edge(1, 0)
            else:
                ids = pa.concat_arrays([ids.slice(len(ids) - 1), batch.column(0)])
                texts = pa.concat_arrays([texts.slice(len(texts) - 1), batch.column(1)])
            yield from compared(ids, texts, part)
        if ids is not None:
            yield edge(2, len(ids) - 1)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = pa.concat_arrays([batch.column(1).slice(i, 1), batch.column(2).slice(i, 1)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), *compare(pair, least_chars)], ["id", *_NAMES])

    scratch = Scratch(spark, "fingerprints")
    found = scratch.write(rows.mapInArrow(within, f"part int, edge int, id {kind}, text string, {FOUND}"), "found")
    # One row per partition, its number alone, in one window.
    heads, tails = found.where("edge = 1"), found.where("edge = 2")
    in_order = Window.orderBy("part")
    after = heads.select("part", F.coalesce(F.lead("part").over(in_order), F.first("part").over(in_order)).alias("next"))
    heads = heads.select(F.col("part").alias("next"), F.col("text").alias("next_text"))
    ends = tails.select("part", "id", "text").join(after, "part").join(heads, "next").select("id", "text", "next_text")
    out = found.where("edge = 0").select("id", *_NAMES).unionByName(ends.mapInArrow(across, f"id {kind}, {FOUND}"))
    return out.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next",
    )
