"""Operator 3: suffix-array dedup by bucket-pointer refinement.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts earlier.

*Buckets.*  Suffixes are put into buckets by their first 2 bytes.  A bucket is refined by the identifier of the
bucket that lies 2 bytes further on, which gives buckets of 4 bytes; these are refined by the new identifiers 4
bytes on, and so on: 8, 16, 32, 64, and at last 100 bytes (64 and the 64 that lie 36 further on).  Identifiers are
64-bit hashes of the pair of identifiers, so each task refines its own texts without asking others.

*Anchors.*  Only few suffixes are sorted across the cluster.  The least 32-byte identifier among the suffixes that
lie within a string of ``LENGTH`` bytes is its anchor (the leftmost of equal ones); equal strings have equal anchors
in equal places.  Consecutive strings with one anchor make a segment; no two of its strings are equal.  Segments are dealt out by anchor, and each anchor's bucket is refined by the
identifiers of the segment's first and last string.  All strings of a segment that isn't the first of its refined
bucket repeat.

*Rest.*  Where an anchor has several refined buckets, their first segments may still have some strings in common.
These segments' bytes are dealt out by anchor and refined down to the single strings.  An anchor with more than
``hot`` different segments is dealt out by single strings instead.

Within a task's group of texts only the first segment of each refined bucket is dealt out by its anchor; of the
others it is known at once that they repeat.  So copies and common passages, however many, are no hot key.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from ledgerline.llm.shared import Scratch
from ledgerline.llm.textbytes import flat, mix
from ledgerline.llm.tokens import by_bytes

LENGTH, ANCHOR = 100, 32
_STEP = {2: 0x9E3779B97F4A7C15, 4: 0xC2B2AE3D27D4EB4F, 8: 0x165667B19E3779F9, 16: 0xD6E8FEB86659FD93, 32: 0xA0761D6478BD642F, 64: 0xE7037ED1A0B428DB}
#: What names a string or segment: document, number of the text among those of one id, place.
_WHERE = ("doc", "tie", "at")


def refined(ids: np.ndarray, width: int, further: int) -> np.ndarray:
    """Identifiers of longer buckets: each bucket's own, refined by that of the suffix ``further`` bytes on."""
    out = ids[: max(len(ids) - further, 0)] * np.uint64(_STEP[width])
    out ^= out >> np.uint64(29)
    out += ids[further:]
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def buckets(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of ANCHOR bytes and of LENGTH bytes from each place on, as far as these lie within the data."""
    wide = data.astype(np.uint64)
    ids = wide[:-1] * np.uint64(257) + wide[1:] + np.uint64(1)
    width = 2
    while width < 64:
        if width == ANCHOR:
            anchor = ids
        ids = refined(ids, width, width)
        width *= 2
    return anchor, refined(ids, 64, LENGTH - 64)


def least_within(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def segments(data: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Of all texts: anchor, context (identifier of all its strings), text, place, and number of strings."""
    if len(data) < LENGTH:
        return {k: np.zeros(0, t) for k, t in (("anchor", np.uint64), ("context", np.uint64), ("doc", np.int64), ("place", np.int64), ("size", np.int64))}
    anchor, whole = buckets(data)
    least = least_within(anchor, LENGTH - ANCHOR + 1)[: len(whole)]
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[: len(whole)]
    inside = np.arange(len(whole)) + LENGTH <= ends[1:][doc]
    edge = np.empty(len(whole), bool)
    edge[0] = True
    edge[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | (inside[1:] != inside[:-1])
    # A string that begins with its anchor is the last with this one; the next may have another of equal value.
    edge[1:] |= (anchor[: len(whole)] == least)[:-1]
    start = np.flatnonzero(edge)
    stop = np.append(start[1:], len(whole))
    full = inside[start]
    start, stop = start[full], stop[full]
    size = stop - start
    context = mix(mix(whole[start] + size.astype(np.uint64)) + whole[stop - 1])
    return {"anchor": least[start], "context": context, "doc": doc[start], "place": start - ends[:-1][doc[start]], "size": size}


def repeated(key: np.ndarray, *where: np.ndarray) -> np.ndarray:
    """For rows sorted by key and place: whether another place comes before in the run of equal keys (columns of
    ``key``).  Rows of the first place itself, where a row of the table is repeated, don't repeat."""
    if not key.shape[1]:
        return np.zeros(0, bool)
    edge = np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)]
    first = np.maximum.accumulate(np.where(edge, np.arange(len(edge)), 0))
    out = np.zeros(len(edge), bool)
    for w in where:
        out |= w != w[first]
    return out


def whole_groups(batches, column: str, least: int = 100_000):
    """Tables of at least some rows that hold all rows of their values of a column by which the rows are sorted."""
    kept: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if n >= least:
            values = batch.column(column)
            last = kept[-1].column(column)[-1].as_py()
            other = pc.fill_null(pc.not_equal(values, pa.scalar(last, values.type)), True).to_numpy(zero_copy_only=False)
            cut = int(np.argmax(other)) if other.any() else batch.num_rows
            kept.append(batch.slice(0, cut))
            n += cut
            if cut == batch.num_rows:
                continue
            yield pa.Table.from_batches(kept).combine_chunks()
            kept, n = [], 0
            batch = batch.slice(cut)
        kept.append(batch)
        n += batch.num_rows
    if n:
        yield pa.Table.from_batches(kept).combine_chunks()


def _columns(table, *names: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy() for c in names]


_RANGE = "doc bigint, tie bigint, at bigint, size bigint"


def dealt_segments(texts: DataFrame, group_bytes: int = 2 << 20) -> DataFrame:
    """Rows (anchor, context, doc, tie, at, size), dealt and sorted by anchor and context.

    Segments that repeat within a task's group of texts have no context and an anchor of any number.
    """

    def run(batches):
        for batch in batches:
            for a, b in by_bytes(pc.binary_length(batch.column(2)).to_pylist(), group_bytes):
                part = batch.slice(a, b - a)
                doc, tie = (part.column(c).to_numpy() for c in (0, 1))
                found = segments(*flat(part.column(2)))
                anchor, context = found["anchor"].astype(np.int64), found["context"].astype(np.int64)
                doc, tie, at = doc[found["doc"]], tie[found["doc"]], found["place"]
                order = np.lexsort((at, tie, doc, context, anchor))
                anchor, context, doc, tie, at, size = (x[order] for x in (anchor, context, doc, tie, at, found["size"]))
                again = repeated(np.stack([anchor, context]), doc, tie, at)
                anchor[again] = mix((doc[again] + at[again]).astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(context, mask=again), *(pa.array(x.astype(np.int64)) for x in (doc, tie, at, size))],
                    names=["anchor", "context", *_WHERE, "size"],
                )

    rows = texts.select("doc", "tie", "text").mapInArrow(run, f"anchor bigint, context bigint, {_RANGE}")
    return rows.repartition("anchor").sortWithinPartitions("anchor", "context", *_WHERE)


def sorted_segments(dealt: DataFrame) -> DataFrame:
    """Rows (anchor, doc, tie, at, size, rivals): without an anchor, strings that repeat; with one, the first segment
    of a context, whose anchor has ``rivals`` contexts, more than one."""

    def run(batches):
        for table in whole_groups(batches, "anchor"):
            known = pc.is_null(table.column("context"))
            doc, tie, at, size = (np.array(x) for x in _columns(table.filter(known), *_WHERE, "size"))
            none = np.ones(len(doc), bool)
            yield _segment_rows(np.zeros(len(doc), np.int64), none, doc, tie, at, size, np.zeros(len(doc), np.int64))
            anchor, context, doc, tie, at, size = _columns(table.filter(pc.invert(known)), "anchor", "context", *_WHERE, "size")
            if not len(anchor):
                continue
            again = repeated(np.stack([anchor, context]), doc, tie, at)
            new = np.r_[True, (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])]
            edge = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1], True])
            rivals = np.repeat(np.add.reduceat(new, edge[:-1], dtype=np.int64), np.diff(edge))
            use = again | (rivals > 1)
            yield _segment_rows(*(x[use] for x in (anchor, again, doc, tie, at, size, rivals)))

    return dealt.mapInArrow(run, f"anchor bigint, {_RANGE}, rivals bigint")


def _segment_rows(anchor, none, doc, tie, at, size, rivals) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor, mask=none), *(pa.array(x) for x in (doc, tie, at, size)), pa.array(rivals, mask=none)], names=["anchor", *_WHERE, "size", "rivals"]
    )


def dealt_strings(texts: DataFrame, firsts: DataFrame, hot: int) -> DataFrame:
    """The bytes of first segments: rows (anchor, doc, tie, at, size, body), dealt and sorted by anchor.

    Those of an anchor with more than ``hot`` contexts become single strings, whose identifier is their anchor;
    single strings that repeat within a batch have no body.
    """
    wanted = firsts.groupBy("doc", "tie").agg(F.collect_list(F.struct("at", "size", "anchor", "rivals")).alias("parts"))
    joined = texts.join(wanted, ["doc", "tie"]).select("doc", "tie", "text", "parts")

    def run(batches):
        for batch in batches:
            rows, single = [], []
            for i in range(batch.num_rows):
                doc, tie = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                data = batch.column(2)[i].as_buffer().to_pybytes()
                for part in batch.column(3)[i].as_py():
                    at, size = part["at"], part["size"]
                    body = data[at : at + size + LENGTH - 1]
                    if part["rivals"] <= hot:
                        rows.append((part["anchor"], doc, tie, at, size, body))
                    else:
                        _, whole = buckets(np.frombuffer(body, np.uint8))
                        single += [(w, doc, tie, at + k, 1, body[k : k + LENGTH]) for k, w in enumerate(whole.astype(np.int64).tolist())]
            first: dict[int, tuple] = {}
            for row in sorted(single, key=lambda r: r[:4]):
                if first.setdefault(row[0], row)[1:4] == row[1:4]:
                    rows.append(row)
                else:
                    rows.append((int(mix(np.array([row[1] + row[3]]).astype(np.uint64)).astype(np.int64)[0]), *row[1:5], None))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], pa.int64() if c < 5 else pa.binary()) for c in range(6)], names=["anchor", *_WHERE, "size", "body"]
            )

    return joined.mapInArrow(run, f"anchor bigint, {_RANGE}, body binary").repartition("anchor").sortWithinPartitions("anchor")


def sorted_strings(dealt: DataFrame) -> DataFrame:
    """Runs of strings (doc, tie, at, size) that repeat, from the rows of ``dealt_strings``."""

    def run(batches):
        for table in whole_groups(batches, "anchor", 10_000):
            known = pc.is_null(table.column("body"))
            yield from table.filter(known).select([*_WHERE, "size"]).to_batches()
            table = table.filter(pc.invert(known)).combine_chunks()
            if not table.num_rows:
                continue
            anchor, doc, tie, at, size = _columns(table, "anchor", *_WHERE, "size")
            data, ends = flat(table.column("body").combine_chunks() if isinstance(table.column("body"), pa.ChunkedArray) else table.column("body"))
            _, whole = buckets(data)
            inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            string = whole[np.repeat(ends[:-1], size) + inner].astype(np.int64)
            anchor, doc, tie, at = np.repeat(anchor, size), np.repeat(doc, size), np.repeat(tie, size), np.repeat(at, size) + inner
            order = np.lexsort((at, tie, doc, string, anchor))
            again = repeated(np.stack([anchor, string])[:, order], doc[order], tie[order], at[order])
            pick = order[again]
            doc, tie, at = doc[pick], tie[pick], at[pick]
            if len(doc):
                order = np.lexsort((at, tie, doc))
                doc, tie, at = doc[order], tie[order], at[order]
                cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1]) | (at[1:] != at[:-1] + 1), True])
                yield pa.RecordBatch.from_arrays([*(pa.array(x[cut[:-1]]) for x in (doc, tie, at)), pa.array(np.diff(cut))], names=[*_WHERE, "size"])

    return dealt.mapInArrow(run, _RANGE)


def repeats(texts: DataFrame, scratch: Scratch, hot: int) -> DataFrame:
    """Runs of repeating strings (doc, tie, at, size) of texts (doc, tie, text)."""
    found = scratch.write(sorted_segments(dealt_segments(texts)), "segments")
    more = scratch.write(sorted_strings(dealt_strings(texts, found.where("anchor is not null"), hot)), "strings")
    return found.where("anchor is null").select(*_WHERE, "size").union(more)


def spans(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that are covered by strings, from runs (place, number) of strings."""
    out: list[tuple[int, int]] = []
    for at, size in sorted(runs):
        end = at + size + LENGTH - 1
        if out and at <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((at, end))
    return out


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = 20_000) -> DataFrame:
    """The rows of ``docs`` with a column ``gone``: the maximal runs of bytes to remove, as (first, end) pairs.

    A null text is empty.  Earlier means a smaller id (null before all others), or an earlier start in the same text.
    Rows of one id with different texts are documents of their own, ordered by a hash of the text; equal
    rows are one document and keep or lose the same bytes.  Strings of fewer than 100 bytes are never removed.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "substrings")
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc"), body.alias("text"))
    marks = rows.groupBy("doc").agg(F.min(F.xxhash64("text")).alias("a"), F.max(F.xxhash64("text")).alias("b"))
    one_text = marks.where("a != b").isEmpty()
    rows = rows.withColumn("tie", F.lit(0).cast("long") if one_text else F.xxhash64("text"))
    runs = repeats(rows.select("doc", "tie", "text"), scratch, hot)
    parts = scratch.write(runs.groupBy("doc", "tie").agg(F.collect_list(F.struct("at", "size")).alias("parts")), "parts")
    return rows.join(parts, ["doc", "tie"], "left").select("row", "text", "parts")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = 20_000) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256; see ``marked`` for nulls, ties and repeated rows.
    Other columns aren't read, and an empty table gives an empty result."""

    def run(batches):
        for batch in batches:
            out = []
            for text, parts in zip(batch.column(1), batch.column(2), strict=True):
                data = text.as_buffer().to_pybytes()
                gone = spans([(p["at"], p["size"]) for p in parts.as_py() or ()])
                out.append((len(data), sum(b - a for a, b in gone), len(gone), hashlib.sha256(cut(data, gone)).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[c] for r in out], pa.int64() if c < 3 else pa.string()) for c in range(4))], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = marked(docs.select(id_col, text_col), id_col, text_col, hot).select(F.col(f"row.`{id_col}`").alias("id"), "text", "parts")
    found = rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return found.withColumnRenamed("id", id_col)


def cut(data: bytes, gone: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for s in gone for x in s), len(data)]
    return b"".join([data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])


def whole_characters(data: bytes, gone: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans, made smaller so that none begins or ends within a character."""
    out = []
    for a, b in gone:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def shortened(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = 20_000) -> DataFrame:
    """All rows and columns of ``docs``, without the repeats in their texts; null texts stay null.

    Characters that are only partly covered stay whole.
    """

    def run(batches):
        for batch in batches:
            out = []
            for text, parts in zip(batch.column(1), batch.column(2), strict=True):
                data = text.as_buffer().to_pybytes()
                gone = spans([(p["at"], p["size"]) for p in parts.as_py() or ()])
                out.append(cut(data, whole_characters(data, gone)).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["row", "text"])

    rows = marked(docs, id_col, text_col, hot)
    found = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string")
    kept = F.when(F.col(f"row.`{text_col}`").isNotNull(), F.col("text"))
    return found.select(*((kept if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
