"""Operator 9: best-fit packing with swap-based local search.

Pieces of equal length can stand for each other, so the packing is worked out on the histogram of lengths
(at most ``capacity`` numbers, whatever the corpus) as *kinds* of bins with a multiplicity.  Best-fit decreasing
gives the first packing.  A local search then moves single pieces, or exchanges one for one, or one for two,
between underfull bins wherever that makes the sum of squared fills larger, so that the emptiest bins run empty.
Spark counts the lengths, ranks the pieces of each length and looks up each piece's place by (length, rank).
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from pyspark.sql.window import Window

from ledgerline.llm.shared import Scratch, partitions
from ledgerline.llm.tokens import by_bytes, encoder

Kind = tuple[tuple[int, int], ...]  # (length, number of pieces) in falling order of lengths


def best_fit(lengths: dict[int, int], capacity: int) -> Counter[Kind]:
    """Best-fit decreasing over a histogram of lengths.

    A piece goes to the bin with the least room that holds it; the next piece of that length goes to the same
    bin while it fits.  So a class of m bins with room r takes r // length pieces each, one bin after another.
    """
    bins: dict[int, list[tuple[Kind, int]]] = defaultdict(list)  # by room
    rooms: list[int] = []

    def put(room: int, kind: Kind, m: int) -> None:
        if m:
            if room not in bins:
                insort(rooms, room)
            bins[room].append((kind, m))

    for length in sorted(lengths, reverse=True):
        left = lengths[length]
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                kind, m = bins[room].pop()
                if not bins[room]:
                    del bins[room]
                    rooms.pop(i)
            else:
                room, kind, m = capacity, (), left
            each = room // length
            full = min(m, left // each)
            put(room - each * length, (*kind, (length, each)), full)
            left -= full * each
            if full < m and left:
                put(room - left * length, (*kind, (length, left)), 1)
                left, full = 0, full + 1
            if kind:
                put(room, kind, m - full)
    out: Counter[Kind] = Counter()
    for found in bins.values():
        for kind, m in found:
            out[kind] += m
    return out


def _fill(kind: Kind) -> int:
    return sum(n * k for n, k in kind)


def _changed(kind: Kind, minus: tuple[int, ...], plus: tuple[int, ...]) -> Kind:
    c = Counter(dict(kind))
    c.update(plus)
    c.subtract(minus)
    return tuple(sorted(((n, k) for n, k in c.items() if k), reverse=True))


def _exchange(a: Kind, b: Kind, room: int) -> tuple[tuple[int, ...], tuple[int, ...], int] | None:
    """What bin a (with ``room``) gives to and takes from the emptier bin b, and by how much a grows.

    Moves, exchanges of one for one, of one of a for two of b, and of two of a for one of b; the largest gain.
    """
    mine, theirs = [n for n, _ in a], [n for n, _ in b]
    pairs = {x + y: (x, y) for i, (x, k) in enumerate(b) for y, _ in b[i if k > 1 else i + 1 :]}
    singles = sorted(theirs)
    doubles = sorted(pairs)
    best: tuple[tuple[int, ...], tuple[int, ...], int] | None = None
    own_pairs = {x + y: (x, y) for i, (x, k) in enumerate(a) for y, _ in a[i if k > 1 else i + 1 :]}
    for give, gone in [((), 0), *(((x,), x) for x in mine), *((p, s) for s, p in own_pairs.items())]:
        for sums, twice in ((singles, False), (doubles, True)):
            if twice and len(give) != 1:
                continue
            i = bisect_left(sums, gone + room + 1) - 1
            if i >= 0 and sums[i] > gone and (best is None or sums[i] - gone > best[2]):
                best = (give, pairs[sums[i]] if twice else (sums[i],), sums[i] - gone)
        if best and best[2] == room:
            break
    return best


def local_search(bins: Counter[Kind], capacity: int, max_moves: int) -> Counter[Kind]:
    """Raise the sum of squared fills by exchanges between underfull bins, until none helps or ``max_moves``.

    The emptiest bin gives; each gain is taken by all bins of the two kinds that can be paired at once.
    """
    done: Counter[Kind] = Counter({k: m for k, m in bins.items() if _fill(k) == capacity})
    open_ = Counter({k: m for k, m in bins.items() if _fill(k) < capacity})
    moves = 0
    while open_ and moves < max_moves:
        giver = min(open_, key=lambda k: (_fill(k), k))
        m = open_.pop(giver)
        found = None
        for taker in sorted(open_, key=lambda k: (-_fill(k), k)):
            moves += 1
            # Exchanges of fuller bins with this one: each gain d > 0 raises the squares by 2 d (fill a - fill b + d).
            if (found := _exchange(taker, giver, capacity - _fill(taker))) is not None or moves >= max_moves:
                break
        if found is None:
            done[giver] += m  # nothing fits any more; no later exchange makes these bins emptier
            continue
        give, take, _ = found
        n = min(m, open_[taker])
        open_[taker] -= n
        if not open_[taker]:
            del open_[taker]
        if m > n:
            open_[giver] += m - n
        for kind in (_changed(taker, give, take), _changed(giver, take, give)):
            if kind:
                (done if _fill(kind) == capacity else open_)[kind] += n
    return done + open_


def places(bins: Counter[Kind]) -> dict[str, np.ndarray]:
    """Runs of ranks of equal length: by (length, first rank) the first sequence, offset and number of bins."""
    ranks: Counter[int] = Counter()
    rows = []
    sequence = 0
    for kind, m in sorted(bins.items(), reverse=True):
        offset = 0
        for length, each in kind:
            rows.append((length, ranks[length], sequence, offset, m))
            ranks[length] += each * m
            offset += each * length
        sequence += m
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return {"key": (table[:, 0] << 44) | table[:, 1], "length": table[:, 0], "first": table[:, 1], "sequence": table[:, 2], "offset": table[:, 3], "bins": table[:, 4]}


def token_pieces(docs: DataFrame, path: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = 4 << 20) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32.

    Each document's ids end with ``end_id``.  Only longer ones are cut; the first piece takes what is over.
    """

    def cut(batches):
        enc = encoder(path)
        for batch in batches:
            texts = batch.column(1)
            for a, b in by_bytes(pc.binary_length(texts).to_pylist(), group_bytes):
                row, piece, start, length, crc = [], [], [], [], []
                ids, sizes = enc.ids_of_group(texts.slice(a, b - a), end_id)
                raw, first = memoryview(np.ascontiguousarray(ids, "<i4")).cast("B"), 0
                for i, n in enumerate(sizes.tolist()):
                    at, k = 0, 0
                    while at < n:
                        size = (n - at) % capacity or capacity
                        row.append(a + i)
                        piece.append(k)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(raw[4 * (first + at) : 4 * (first + at + size)]))
                        at, k = at + size, k + 1
                    first += n
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(pieces: DataFrame, capacity: int, max_moves: int = 200_000) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece, length (1 to ``capacity``) and ids_crc32.

    ``pieces`` is read twice, so it should be a written table.  Ranks within a length are dealt over salts, as
    many as there are shuffle partitions, since a third of all pieces may have one length.
    """
    spark = pieces.sparkSession
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(partitions(spark))))
    counts = salted.groupBy("length", "salt").count()
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    table = places(local_search(best_fit(histogram, capacity), capacity, max_moves))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy(), rank.to_numpy()
        run = np.searchsorted(table["key"], (n << 44) | r, "right") - 1
        j, m = r - table["first"][run], table["bins"][run]
        return pd.DataFrame({"sequence_id": table["sequence"][run] + j % m, "offset": table["offset"][run] + j // m * n})

    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(within) - 1).join(starts, ["length", "salt"])
    return ranked.withColumn("p", place("length", F.col("rank") + F.col("before"))).select(
        *(c for c in pieces.columns), F.col("p.sequence_id").alias("sequence_id"), F.col("p.offset").alias("offset")
    )


def pack_documents(docs: DataFrame, path: str, end_id: int = 0, capacity: int = 2048, max_moves: int = 200_000) -> DataFrame:
    """All documents in sequences of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    A null text is empty and makes one piece, its end id.  Equal rows are documents of their own.  Null ids
    stay.  An empty table gives an empty result.  Only doc_id and text are read.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    return pack(scratch.write(token_pieces(docs, path, end_id, capacity), "pieces"), capacity, max_moves)
