"""Operator 10: n-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles (64-bit hashes).  With Jaccard similarity J >= 3/4 two sets of
sizes s <= t have t <= 4s/3 and differ in at most D = (s + t) / 7 shingles.

1. *Sets*: equal sets are one point; its representative is the least id.
2. *Lonely sets go*: a set of s shingles with a partner shares all but s/4 of them.  The shingles in a part of the
   hash space a little over a quarter are dealt out; a set with more than s/4 shingles there that no other set has
   can't have a partner.
3. *Sketches*: size bands overlap so that both sets of a link lie in a common band.  The band fixes into how many
   places the hash space is cut; a set's sketch has in each place the XOR of its shingles' hashes.  A shingle
   changes one place, so sketches of linked sets differ in at most D places, and as more than D places are filled,
   they agree in a filled one (pigeonhole).  Place and XOR make a key.  At most D keys of either set are not the
   other's, so the least key that they share is among the D + 1 least of both: only these are joined.  In narrow
   bands, and in bands with a set that fills too few places, each shingle has a place of its own.
4. *Check*: a sketch of parity bits, some for each shingle, has a Hamming distance of at most the number of
   differing shingles; pairs whose distance is above D are out.  The others are compared exactly.

Each set is first compared with one set for each of its ``STARS`` least keys a band, twice, the second time with one
of another component.  What near copies those leave apart is found by all D + 1 keys: sets of several components that
share a key meet, once however many keys the same sets share, and there sizes and short sketches are compared before
a pair leaves.  Only sets that still share all but a quarter of their shingles with other components deal their keys;
linked groups never expand into all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ledgerline.llm.components import components
from ledgerline.llm.shared import Scratch, bucket_names
from ledgerline.llm.textbytes import flat, hashes, mix, words
from ledgerline.llm.tokens import by_bytes

PERCENT = 75
#: Least parity bits of a set; larger sets have two to four for each shingle.  So many go to the meetings.
SKETCH_BITS = 1024
#: Bands whose largest set is at most this have a place for each shingle.
SINGLE = 100
#: Places of a wider band, as a share of its largest set.
PLACES = 0.45
#: Keys of a set in each band by which it looks for a near copy at first.
STARS = 4
RATIO = 4 / 3
#: Rows of a group of texts or sets at most; their numbers, with a bit beside them, fit into 16 bits.
MOST_ROWS = 1 << 15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def shingle_sets(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted; of a text with fewer words its whole sequence; none without words."""
    data, ends = flat(texts)
    data = _LOWER[data]
    start, stop, doc = words(data, ends)
    word = hashes(data, start, stop)
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    count = np.diff(first)
    run = word.copy()
    for k in range(1, width):
        run[:-k] = mix(run[:-k] * np.uint64(0x9E3779B97F4A7C15) + word[k:]) if len(run) > k else run[:-k]
    out = []
    for i, n in enumerate(count.tolist()):
        a = first[i]
        if n >= width:
            out.append(np.unique(run[a : a + n - width + 1]))
        elif n:
            h = np.uint64(n)
            for w in word[a : a + n]:
                h = mix(np.array([h ^ w]) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(n))[0]
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _share(size: np.ndarray | float) -> np.ndarray | float:
    """The part of the hash space in which a set of this size is judged."""
    return np.minimum(1.0, 0.25 + 1 / np.sqrt(np.maximum(size, 1)))


def _signed(x) -> int:
    return int(np.uint64(x).astype(np.int64))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _groups(batches, column: int, most: int) -> Iterator[tuple[pa.RecordBatch, int, int]]:
    for batch in batches:
        for a, b in by_bytes(pc.binary_length(batch.column(column)).to_pylist(), most):
            for k in range(a, b, MOST_ROWS):
                yield batch, k, min(k + MOST_ROWS, b)


def set_marks(docs: DataFrame, id_col: str, text_col: str, width: int, group_bytes: int = 4 << 20) -> DataFrame:
    """id, n (size of the set), and two digests of the set, d1 and d2."""

    def run(batches):
        for batch, a, b in _groups(batches, 1, group_bytes):
            sets = shingle_sets(batch.column(1).slice(a, b - a), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), *(pa.array([_digests(s)[k] for s in sets], pa.int64()) for k in (0, 1))],
                names=["id", "n", "d1", "d2"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return _texts(docs, id_col, text_col).mapInArrow(run, f"id {kind}, n bigint, d1 bigint, d2 bigint")


def _digests(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit digests of a set."""
    with np.errstate(over="ignore"):
        return _signed(mix(s).sum(dtype=np.uint64)), _signed(np.bitwise_xor.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D))) if len(s) else 0)


def _deal_shingles(sets: list[np.ndarray], owners: np.ndarray, groups: np.ndarray, buckets: np.ndarray, salt: int = 0) -> pa.RecordBatch | None:
    """The shingles in which sets are judged, one row per bucket: (bucket, chunk, rows, low, at, groups, runs).

    A set of s shingles is judged by those in ``_share(s)`` of the hash space, and sends those that a smaller
    partner is judged by.  Shingles travel as 48 bits beside those that choose the bucket; two that fall
    together only seem shared, which keeps a set that might have gone.

    All sets given make a chunk, and ``at`` has their numbers in it, doubled, plus 1 for judged shingles; ``runs`` says how
    many shingles each of them has.  The last row is the chunk's table: how many rows it dealt, owners (as ``at``),
    groups, and how many shingles each is judged by (as ``runs``).  Copies within the chunk are left out.
    """
    size = np.array([len(s) for s in sets])
    if not size.sum():
        return None
    first = np.unique(np.stack([owners, groups]), axis=1, return_index=True)[1]
    one = np.zeros(len(sets), bool)
    one[first] = True
    every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    where = (every >> np.uint64(11)).astype(np.float64) / 2.0**53
    sent = (where < _share(0.75 * size)[owner]) & one[owner]
    every, owner, judged = every[sent], owner[sent], (where < _share(size)[owner])[sent]
    if not len(every):
        return None
    bucket = (every % np.uint64(len(buckets))).astype(np.int64)
    run = owner * 2 + judged
    order = np.lexsort((run, bucket))
    bucket, every, run = bucket[order], every[order], run[order]
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
    used = np.flatnonzero(np.bincount(owner, minlength=len(sets)))
    with np.errstate(over="ignore"):
        place = np.arange(1, 2 * len(sets), 2, np.uint64)
        content = mix(owners.astype(np.uint64) + mix(groups.astype(np.uint64)) * place).sum(dtype=np.uint64)
        chunk = _signed(content + np.uint64(salt) * np.uint64(0x9E3779B97F4A7C15))
    number = np.cumsum(np.bincount(used, minlength=len(sets))) - 1
    rows = []
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        change = np.r_[True, run[x + 1 : y] != run[x : y - 1], True]
        change[::_LONGEST] = True
        new = np.flatnonzero(change)
        low = every[x:y].astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]
        at = run[x:y][new[:-1]]
        parts = ((number[at >> 1] * 2 + (at & 1)).astype("<u2"), groups[at >> 1].astype("<i8"), np.diff(new).astype(np.uint8))
        rows.append((int(buckets[bucket[x]]), chunk, 0, low.tobytes(), *(p.tobytes() for p in parts)))
    judges = np.bincount(owner[judged], minlength=len(sets))[used].astype("<u4")
    table = (b"", owners[used].astype("<i8").tobytes(), groups[used].astype("<i8").tobytes(), judges.tobytes())
    rows.append((int(buckets[chunk % len(buckets)]), chunk, len(rows), *table))
    kinds = (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=_DEALT)


_LONGEST = 255
_DEALT = ["bucket", "chunk", "rows", "low", "at", "groups", "runs"]
_DEALT_KIND = "bucket int, chunk bigint, rows int, low binary, at binary, groups binary, runs binary"


def _shared(parts: list) -> list[tuple[bytes, bytes]]:
    """Of one bucket's rows (low, at, groups, runs), each row's sets and how many of their judged shingles sets of other
    groups have; sets that share none are left out."""
    low, at, group, runs = (np.frombuffer(b"".join(p[k] for p in parts), t) for k, t in enumerate((np.uint8, "<u2", "<i8", np.uint8)))
    key = np.zeros((len(low) // 6, 8), np.uint8)
    key[:, :6] = low.reshape(-1, 6)
    key = key.view("<u8")[:, 0]
    run = np.repeat(np.arange(len(runs), dtype=np.int32), runs)
    order = np.argsort(key)
    key, run = key[order], run[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    of = group[run]
    several = np.minimum.reduceat(of, starts) != np.maximum.reduceat(of, starts)
    mine = np.repeat(several, np.diff(np.append(starts, len(key)))) & (at[run] & 1 == 1)
    n = np.bincount(run[mine], minlength=len(runs))
    ends = np.cumsum([0, *(len(p[3]) for p in parts)])
    out = []
    for x, y in zip(ends[:-1], ends[1:], strict=True):
        some = x + np.flatnonzero(n[x:y])
        out.append(((at[some] >> 1).astype("<u2").tobytes(), n[some].astype(np.uint8).tobytes()))
    return out


def _count_lonely(dealt: DataFrame) -> DataFrame:
    """owner, group and the number of the owner's judged shingles that only sets of its group have, where there are any.

    Buckets answer each chunk with what its sets share, in one row for each that it dealt; so what goes back is bounded by the
    shared shingles, whatever the number of buckets.
    """

    def answer(batches):
        by_bucket: dict[int, list] = {}
        for batch in batches:
            for bucket, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                by_bucket.setdefault(bucket, []).append(rest)
        while by_bucket:
            _, found = by_bucket.popitem()
            tables = [(chunk, rows, at, groups, runs) for chunk, rows, _, at, groups, runs in found if rows]
            parts = [p for p in found if not p[1]]
            rows = [(p[0], 0, *x, b"") for p, x in zip(parts, _shared([p[2:] for p in parts]) if parts else [], strict=True)] + tables
            kinds = (pa.int64(), pa.int32(), *[pa.binary()] * 3)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["chunk", "rows", "at", "n", "judged"])

    def gather(batches):
        by_chunk: dict[int, list] = {}
        for batch in batches:
            for chunk, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                by_chunk.setdefault(chunk, []).append(rest)
        while by_chunk:
            _, found = by_chunk.popitem()
            tables, answers = [x for x in found if x[0]], [x for x in found if not x[0]]
            if sum(x[0] for x in tables) != len(answers):
                raise RuntimeError("a group of sets was dealt twice, in different orders")
            _, owners, groups, judged = tables[0]  # the same chunk dealt twice has the same answers twice
            owners, groups = (np.frombuffer(x, "<i8") for x in (owners, groups))
            at, n = np.frombuffer(b"".join(x[1] for x in answers), "<u2"), np.frombuffer(b"".join(x[2] for x in answers), np.uint8)
            shared = np.bincount(at, n, len(owners)).astype(np.int64) // len(tables)
            lonely = np.frombuffer(judged, "<u4") - shared
            some = np.flatnonzero(lonely)
            yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (owners, groups, lonely)], names=["owner", "group", "n"])

    answers = dealt.repartition("bucket").mapInArrow(answer, "chunk bigint, rows int, at binary, n binary, judged binary")
    found = answers.repartition("chunk").mapInArrow(gather, "owner bigint, group bigint, n bigint")
    return found.groupBy("owner", "group").agg(F.max("n").alias("lonely"))  # copies have the same number


def lonely_counts(docs: DataFrame, text_col: str, width: int, group_bytes: int = 4 << 20) -> DataFrame:
    """d1 (as ``owner``), d2 (as ``group``) and the number of their set's judged shingles that no other among ``docs`` has."""
    buckets = bucket_names(docs.sparkSession)

    def deal(batches):
        salt = TaskContext.get().partitionId() << 32
        for batch, a, b in _groups(batches, 0, group_bytes):
            sets = shingle_sets(batch.column(0).slice(a, b - a), width)
            digests = np.array([_digests(s) for s in sets], np.int64).reshape(-1, 2)
            salt += 1
            if (out := _deal_shingles(sets, digests[:, 0], digests[:, 1], buckets, salt)) is not None:
                yield out

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return _count_lonely(texts.mapInArrow(deal, _DEALT_KIND))


def lonely_in_component(sets: DataFrame, group_bytes: int = 4 << 20) -> DataFrame:
    """id (as ``owner``), root (as ``group``) and the number of its judged shingles that no set of another component has."""
    buckets = bucket_names(sets.sparkSession)

    def deal(batches):
        salt = TaskContext.get().partitionId() << 32
        for batch, a, b in _groups(batches, 2, group_bytes):
            ids, roots = (batch.column(c).slice(a, b - a).to_numpy() for c in (0, 1))
            found = [np.frombuffer(x, "<u8") for x in batch.column(2).slice(a, b - a).to_pylist()]
            salt += 1
            if (out := _deal_shingles(found, ids, roots, buckets, salt)) is not None:
                yield out

    return _count_lonely(sets.select("id", "root", "shingles").mapInArrow(deal, _DEALT_KIND))


def parity_sketch(s: np.ndarray) -> np.ndarray:
    """Parities, as bytes: each shingle turns over one bit.  The number of bits is a power of two, and the halves
    of a sketch, XORed, are the sketch of half as many bits."""
    size = max(SKETCH_BITS, 1 << int(2 * len(s) - 1).bit_length())
    bits = np.bincount((mix(s) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little")


def sketch_distance(one: np.ndarray, two: np.ndarray) -> int:
    """Of two sketches as bytes: a lower bound of the number of shingles that only one of the sets has."""
    while len(one) != len(two):
        if len(one) < len(two):
            one, two = two, one
        one = one[: len(one) // 2] ^ one[len(one) // 2 :]
    return int(np.bitwise_count(one ^ two).sum(dtype=np.int64))


def short_sketch(s: np.ndarray) -> np.ndarray:
    """The parity sketch folded to SKETCH_BITS."""
    return folded_sketch(parity_sketch(s))


def folded_sketch(sketch: np.ndarray) -> np.ndarray:
    """The short sketch of a set from its parity sketch."""
    while len(sketch) * 8 > SKETCH_BITS:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def set_table(docs: DataFrame, id_col: str, text_col: str, width: int, group_bytes: int = 4 << 20) -> DataFrame:
    """id, n, sketch, thin (the set's bands of whose places it fills too few), shingles (64-bit, sorted, as bytes)."""

    def run(batches):
        for batch, a, b in _groups(batches, 1, group_bytes):
            sets = shingle_sets(batch.column(1).slice(a, b - a), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array([parity_sketch(s).tobytes() for s in sets], pa.binary()),
                 pa.array([thin_bands(s) for s in sets], pa.list_(pa.int32())), pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())],
                names=["id", "n", "sketch", "thin", "shingles"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return _texts(docs, id_col, text_col).mapInArrow(run, f"id {kind}, n bigint, sketch binary, thin array<int>, shingles binary")


def bands(n: int) -> list[tuple[int, int, int]]:
    """The bands of a set of n shingles: (number, places, most differing shingles); 0, 0: a place for each shingle.

    Band j holds the sizes from RATIO^j up to RATIO^(j+2), without the end.  A pair is looked for in the band j in
    whose first half its smaller set lies; so the second band of a set is for smaller partners only.
    """
    j = int(np.floor(np.log(n) / np.log(RATIO) + 1e-9))
    found: list[tuple[int, int, int]] = []
    for k, partner in ((j, int(n * RATIO)), (j - 1, min(n, int(RATIO**j) + 1))):
        largest = RATIO ** (k + 2)
        band, places = (0, 0) if largest <= SINGLE else (k, int(np.ceil(PLACES * largest)))
        if not found or found[0][0] != band:
            found.append((band, places, (n + partner) * (100 - PERCENT) // (100 + PERCENT)))
    return found


def place_keys(s: np.ndarray, band: int, places: int) -> np.ndarray:
    """Sorted keys of the filled places of the set's sketch in a band."""
    if not places:
        return np.unique(mix(s ^ np.uint64(band)))
    place = (mix(s ^ np.uint64(band)) % np.uint64(places)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    at = np.flatnonzero(np.r_[True, np.diff(place[order]) > 0])
    xor = np.bitwise_xor.reduceat(s[order], at)
    return np.sort(mix(mix(xor) + place[order][at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band)))


def thin_bands(s: np.ndarray) -> list[int]:
    """The bands of which a set fills too few places for the pigeonhole."""
    return [band for band, places, most in (bands(len(s)) if len(s) else ()) if places and len(place_keys(s, band, places)) <= most]


def sketch_keys(s: np.ndarray, single: frozenset[int] = frozenset(), least: int | None = None) -> np.ndarray:
    """In each of the set's bands the least keys, one more than linked sets differ in, or ``least`` of them if that is
    fewer.  Bands in ``single`` have a place for each shingle."""
    if not len(s):
        return np.zeros(0, np.uint64)
    cut = [(most + 1, place_keys(s, band, 0 if band in single else places)) for band, places, most in bands(len(s))]
    return np.concatenate([keys[: n if least is None else min(n, least)] for n, keys in cut])


def _deal_keys(sets: DataFrame, single: frozenset[int]) -> DataFrame:
    """The keys of sets (id, shingles, root), dealt into buckets: rows (bucket, keys, ids, roots), lists of one length."""
    buckets = bucket_names(sets.sparkSession)

    def deal(batches):
        for batch, a, b in _groups(batches, 1, 4 << 20):
            keys = [sketch_keys(np.frombuffer(x, "<u8"), single) for x in batch.column(1).slice(a, b - a).to_pylist()]
            ids, roots = (batch.column(c).slice(a, b - a).to_numpy() for c in (0, 2))
            owner, every = np.repeat(np.arange(b - a), [len(k) for k in keys]), np.concatenate(keys)
            bucket = (every % np.uint64(len(buckets))).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, every, owner = bucket[order], every[order], owner[order]
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(every) else np.zeros(1, int)
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                lists = [v.tobytes() for v in (every[x:y].astype("<u8"), ids[owner[x:y]].astype("<i8"), roots[owner[x:y]].astype("<i8"))]
                yield pa.RecordBatch.from_arrays([pa.array([int(buckets[bucket[x]])], pa.int32()), *(pa.array([v], pa.binary()) for v in lists)], names=["bucket", "keys", "ids", "roots"])

    return sets.select("id", "shingles", "root").mapInArrow(deal, "bucket int, keys binary, ids binary, roots binary").repartition("bucket")


def meetings(sets: DataFrame, single: frozenset[int]) -> DataFrame:
    """Distinct rows (mark, id): the sets that share a key, if they are of several components.

    The mark is made of the sets' ids, so keys of the same sets, which near copies share by the hundred, make one
    meeting, in whatever buckets they are; if two marks fall together, more sets meet.
    """

    def meet(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for bucket, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found.setdefault(bucket, []).append(rest)
        while found:
            _, parts = found.popitem()
            key, ids, root = (np.frombuffer(b"".join(p[k] for p in parts), t) for k, t in enumerate(("<u8", "<i8", "<i8")))
            order = np.argsort(key)
            key, ids, root = key[order], ids[order], root[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.append(first, len(key)))
            several = np.minimum.reduceat(root, first) != np.maximum.reduceat(root, first)
            mark = mix(np.add.reduceat(mix(ids.astype(np.uint64)), first) + size.astype(np.uint64))
            pick = np.zeros(len(first), bool)
            pick[np.unique(mark, return_index=True)[1]] = True
            used = np.repeat(pick & several, size)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(mark, size)[used].view(np.int64)), pa.array(ids[used])], names=["mark", "id"])

    return _deal_keys(sets, single).mapInArrow(meet, "mark bigint, id bigint").distinct()


def least_keys(sets: DataFrame, single: frozenset[int]) -> DataFrame:
    """(id, key): of each set the ``STARS`` least keys of each of its bands."""

    def run(batches):
        for batch, a, b in _groups(batches, 1, 4 << 20):
            keys = [sketch_keys(np.frombuffer(x, "<u8"), single, STARS) for x in batch.column(1).slice(a, b - a).to_pylist()]
            ids = batch.column(0).slice(a, b - a).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, [len(k) for k in keys])), pa.array(np.concatenate(keys).view(np.int64))], names=["id", "key"])

    return sets.select("id", "shingles").mapInArrow(run, "id bigint, key bigint")


def star_pairs(keys: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) from rows (id, root, key): of each key the set a with the least root, and each set b of
    another root."""
    lead = keys.groupBy("key").agg(F.min(F.struct("root", "id")).alias("lead"), F.count("*").alias("n")).where("n > 1")
    found = keys.join(lead.select("key", "lead"), "key").where("lead.root != root")
    return found.select(F.col("lead.id").alias("a"), F.col("id").alias("b")).distinct()


def _most(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """How many shingles linked sets of these sizes may differ in; -1 if the sizes alone forbid a link."""
    return np.where(100 * np.minimum(s, t) >= PERCENT * np.maximum(s, t), (s + t) * (100 - PERCENT) // (100 + PERCENT), -1)


def short_distance(sketches: list[bytes]):
    """A function of two arrays of numbers of sets: the Hamming distances of their short sketches."""
    length = np.array([len(x) // 8 for x in sketches])
    folded = {}
    for words_ in sorted({int(n) for n in length}):
        at = np.flatnonzero(length >= words_)
        rows = np.zeros((len(sketches), words_), np.uint64)
        for n in sorted({int(n) for n in length[at]}):
            same = at[length[at] == n]
            wide = np.frombuffer(b"".join(sketches[i] for i in same), "<u8").reshape(len(same), n)
            while wide.shape[1] > words_:
                wide = wide[:, : wide.shape[1] // 2] ^ wide[:, wide.shape[1] // 2 :]
            rows[same] = wide
        folded[words_] = rows

    def distance(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        both = np.minimum(length[i], length[j])
        for words_, rows in folded.items():
            at = np.flatnonzero(both == words_)
            out[at] = np.bitwise_count(rows[i[at]] ^ rows[j[at]]).sum(axis=1)
        return out

    return distance


def _short(sets: DataFrame) -> DataFrame:
    """id, root, n and short sketch of sets (id, root, n, sketch)."""

    def run(batches):
        for batch in batches:
            short = [folded_sketch(np.frombuffer(x.as_buffer(), np.uint8)).tobytes() for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(3)), pa.array(short, pa.binary())], names=["id", "root", "n", "short"])

    return sets.select("id", "root", "n", "sketch").mapInArrow(run, "id bigint, root bigint, n bigint, short binary")


def cross_pairs(sets: DataFrame, single: frozenset[int], tile: int = 512) -> DataFrame:
    """Distinct pairs (a, b) of sets that share a key, in different components, whose sizes and short sketches allow a
    link; see ``sketched`` for the whole sketches, which are too long to go to every meeting."""

    def pairs(batches):
        mark, ids, root, size, sketches = [], [], [], [], []
        for batch in batches:
            for out, c in zip((mark, ids, root, size), range(4), strict=True):
                out.append(batch.column(c).to_numpy())
            sketches += batch.column(4).to_pylist()
        if not sketches:
            return
        mark, ids, root, size = (np.concatenate(x) for x in (mark, ids, root, size))
        ids, first, number = np.unique(ids, return_index=True, return_inverse=True)  # a set comes once for each meeting
        root, size = root[first], size[first]
        distance = short_distance([sketches[i] for i in first])
        order = np.lexsort((number, mark))
        mark, owner = mark[order], number[order]
        starts = np.flatnonzero(np.r_[True, mark[1:] != mark[:-1], True])
        out = []
        for x, y in zip(starts[:-1], starts[1:], strict=True):
            at = owner[x:y]
            for k in range(0, len(at), tile):
                i = at[k : k + tile]
                for m in range(k, len(at), tile):
                    j = at[m : m + tile]
                    most = _most(size[i][:, None], size[j][None, :])
                    p, q = np.nonzero((root[i][:, None] < root[j][None, :]) & (most >= 0))
                    if m > k:
                        r, t = np.nonzero((root[i][:, None] > root[j][None, :]) & (most >= 0))
                        p, q = np.concatenate([p, r]), np.concatenate([q, t])
                    near = distance(i[p], j[q]) <= most[p, q]
                    u, v = i[p[near]], j[q[near]]
                    out.append(np.unique(np.minimum(u, v).astype(np.int64) * len(ids) + np.maximum(u, v)))
        i, j = np.divmod(np.unique(np.concatenate(out)), len(ids))
        yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[j])], names=["a", "b"])

    met = meetings(sets, single).join(_short(sets), "id").select("mark", "id", "root", "n", "short")
    return met.repartition("mark").mapInArrow(pairs, "a bigint, b bigint").distinct()


def _sides(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """The pairs with columns of both sets, x_a and x_b; only sets that are in a pair are dealt out."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    used = sets.select("id", *columns).join(ids, "id", "left_semi")
    for c in ("a", "b"):
        pairs = pairs.join(used.select(F.col("id").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in columns)), c)
    return pairs.select("a", "b", *(f"{x}_{c}" for x in columns for c in ("a", "b")))


def sketched(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose parity sketches allow a link."""

    def run(batches):
        for batch in batches:
            most = _most(batch.column(2).to_numpy(), batch.column(3).to_numpy())
            pairs = zip(most.tolist(), batch.column(4), batch.column(5), strict=True)
            keep = [m >= 0 and sketch_distance(*(np.frombuffer(x.as_buffer(), np.uint8) for x in two)) <= m for m, *two in pairs]
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in (0, 1)], names=["a", "b"])

    return _sides(pairs, sets, "n", "sketch").mapInArrow(run, "a bigint, b bigint")


def checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are linked: 100 * intersection >= 75 * union."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                one, two = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(one) + len(two) - both))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in (0, 1)], names=["a", "b"])

    return _sides(pairs, sets, "shingles").mapInArrow(run, "a bigint, b bigint")


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """Per row: id, n_shingles, component_id (the least id reachable by links, the row's own included).

    A null text has no words.  Sets without shingles link with nothing.  Rows without an id have no component
    and link with nothing.  Rows of one id are one node, with the links of all of them.  Equal rows give equal
    rows.  Other columns aren't read, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    docs = docs.withColumn(id_col, F.col(id_col).cast("long"))
    marks = scratch.write(set_marks(docs, id_col, text_col, width), "marks")
    full = marks.where("id is not null and n > 0")
    points = full.groupBy("n", "d1", "d2").agg(F.min("id").alias("point"))
    lonely = lonely_counts(docs.where(F.col(id_col).isNotNull()), text_col, width)
    alone = (F.col("d1") == F.col("owner")) & (F.col("d2") == F.col("group"))
    left = points.join(lonely, alone, "left").where("4 * coalesce(lonely, 0) <= n").select(F.col("point").alias(id_col)).distinct()
    # Texts are dealt out at every size: a broadcast of the ids, which grow with the table, would only do for small ones.
    sets = scratch.write(set_table(docs.select(id_col, text_col).join(left.hint("merge"), id_col), id_col, text_col, width).where("n > 0"), "sets")
    single = frozenset(r["band"] for r in sets.select(F.explode("thin").alias("band")).distinct().collect())  # one row a band at most

    keys = scratch.write(least_keys(sets, single), "keys")
    stars = scratch.write(star_pairs(keys.withColumn("root", F.col("id"))), "stars-1")
    likely = sketched(stars, sets).groupBy("b").agg(F.min("a").alias("a"))
    links = scratch.write(checked(scratch.write(likely.select("a", "b"), "likely-1"), sets), "links-1")
    roots = scratch.write(components(links, scratch, "steps-1"), "roots-1")
    stars = scratch.write(star_pairs(_rooted(keys, roots)), "stars-2")
    links = scratch.write(checked(scratch.write(sketched(stars, sets), "likely-2"), sets), "links-2")
    roots = scratch.write(components(_joined(roots, links), scratch, "steps-2"), "roots-2")
    scratch.drop("keys")
    # The same argument as in step 2, for components: a set that lacks too many shingles outside its own
    # component has no partner there.
    lonely = lonely_in_component(_rooted(sets, roots))
    still = _rooted(sets.select("id", "n"), roots).join(lonely, F.col("id") == F.col("owner"), "left").where("4 * coalesce(lonely, 0) <= n")
    still = scratch.write(still.select("id", "root"), "open")
    # Dealt out at every size, like the texts: the open ids grow with the table too.
    crossed = scratch.write(cross_pairs(sets.join(still.hint("merge"), "id"), single), "crossed")
    likely = scratch.write(sketched(crossed, sets), "likely")
    links = scratch.write(checked(likely, sets), "links")
    scratch.drop("sets", "open", "crossed", "likely")
    roots = components(_joined(roots, links), scratch, "steps-3")

    points = points.join(roots, F.col("point") == F.col("node"), "left")
    points = points.select("n", "d1", "d2", F.coalesce("root", "point").alias("root"))
    # Rows of one id may hold several sets: its component is the least that any of them reaches.
    by_id = full.join(points, ["n", "d1", "d2"]).select("id", "root").distinct()
    nodes = _same_id(by_id, scratch)
    done = marks.join(nodes, "id", "left")
    return done.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce(F.when(F.col("n") > 0, F.col("root")), "id").alias("component_id"))


def _same_id(by_id: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root), ids with several roots bringing these together."""
    many = by_id.groupBy("id").agg(F.min("root").alias("a"), F.max("root").alias("b"))
    merged = components(many.where("a != b").select("a", "b"), scratch, "ids").select("node", F.col("root").alias("to"))
    return many.join(merged, F.col("a") == F.col("node"), "left").select("id", F.coalesce("to", "a").alias("root"))


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows with the root of their id."""
    return rows.join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id")).drop("node")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links.select("a", "b"))
