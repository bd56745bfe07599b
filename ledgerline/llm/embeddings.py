"""Operator 8: near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

* A bounded sample of the vectors is projected on its principal directions, and rotations are learned (ITQ) that
  bring the projections close to the corners of a cube.  The signs of the rotated vector are its code; several
  learned rotations make it ``BITS`` bits long, or longer.
* The code is cut into strings of ``STRING`` bits, one table for each.  Two codes that differ in fewer places than
  there are tables share a string, and meet in that table's bucket.
* Taking the mean away widens the angle of a linked pair where the vectors share a direction.  So the number of
  tables, and then the length of the strings, is learned: partners at the very threshold are made for vectors of the
  sample, and tables are added, or strings shortened, until ``RECALL`` of these pairs meet.
* In each bucket the original vectors are compared in double precision.  A link is counted in the first table in
  which its two vectors meet.  No pairs leave the task: only each vector's number of links, and one link of each
  vector to the least of the bucket's component that it is in.

Equal vectors are one point with a number of copies.  A bucket of more than ``block`` vectors is cut into blocks, and
each pair of blocks is a group of its own.  Groups come sorted and one after the other, so a task holds two blocks
and a few batches however large a bucket is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from ledgerline.llm.components import components
from ledgerline.llm.shared import Scratch

BITS, STRING = 256, 16
TABLES = BITS // STRING
RECALL, MOST_TABLES = 0.95, 64


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; first by the largest component, lest squares overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def learn_rotation(x: np.ndarray, seed: int, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """ITQ: the mean of the rows of x, and a projection (dimension x bits) whose signs are the code.

    Where the dimension is above ``BITS`` only the first principal directions count.
    """
    mean = x.mean(axis=0)
    values, vectors = np.linalg.eigh((x - mean).T @ (x - mean))
    basis = vectors[:, np.argsort(-values)][:, :BITS]
    v = (x - mean) @ basis
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(v.shape[1],) * 2))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(v @ turn >= 0, 1.0, -1.0).T @ v)
        turn = (left @ right).T
    return mean, basis @ turn


def partners(x: np.ndarray, least: float, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Rows of x and for each a vector whose cosine to it is ``least``: half of them off in any direction, half in the
    direction of the difference of two other rows."""
    rng = np.random.default_rng(seed)
    a = x[rng.integers(0, len(x), 4000)]
    side = rng.normal(size=a.shape)
    apart = x[rng.integers(0, len(x), len(a))] - x[rng.integers(0, len(x), len(a))]
    other = (np.arange(len(a)) % 2 == 0) & (np.abs(apart).max(axis=1) > 1e-9)
    side[other] = apart[other]
    side -= (side * a).sum(axis=1, keepdims=True) * a
    length = np.linalg.norm(side, axis=1, keepdims=True)
    full = length[:, 0] > 1e-9
    a, side = a[full], side[full] / length[full]
    return a, least * a + np.sqrt(max(0.0, 1 - least * least)) * side


def learn_codes(x: np.ndarray, least: float = 0.95) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean, projection to the bits of all tables, from as many learned rotations as that takes, and bits a string.

    Tables come first, since more of them cost in proportion; shorter strings, whose buckets are larger, only where
    ``MOST_TABLES`` do not bring ``RECALL`` of pairs at the threshold together.
    """
    a, b = partners(x, least)
    found = []
    for length in (STRING, 12, 10, 8, 6, 4, 2, 1):
        for tables in (TABLES, 24, 32, 48, MOST_TABLES):
            while sum(p.shape[1] for _, p in found) < tables * length:
                found.append(learn_rotation(x, len(found)))
            code = found[0][0], np.hstack([p for _, p in found])[:, : tables * length], length
            if not len(a):
                return code
            met = (strings(a, code) == strings(b, code)).any(axis=1)
            if min(met[::2].mean(), met[1::2].mean()) >= RECALL:
                return code
    return code


def strings(x: np.ndarray, code: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """The code of each row of x as one unsigned 16-bit number for each table."""
    mean, projection, length = code
    bits = ((x - mean) @ projection >= 0).reshape(len(x), -1, length)
    return np.packbits(np.pad(bits, ((0, 0), (0, 0), (0, 16 - length))), axis=2).view("<u2")[:, :, 0]


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def compare(ids: np.ndarray, copies: np.ndarray, codes: np.ndarray, x: np.ndarray, side: np.ndarray, table: int, least: float, tile: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a group, those of side 0 against those of side 1, or of side 2 against each other: each row's links
    (copies of others counted) that no earlier table has, and the least id that it is connected to by the links found
    here."""
    within = bool((side == 2).all())
    left, right = (np.arange(len(ids)),) * 2 if within else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    links = np.zeros((len(left), len(right)), bool)
    number = np.zeros(len(ids), np.int64)
    for a in range(0, len(left), tile):
        rows = left[a : a + tile]
        near = (x[rows] @ x[right].T >= least) & (ids[rows, None] != ids[None, right])
        links[a : a + tile] = near
        i, j = np.nonzero(near)
        if len(i):
            i, j = rows[i], right[j]
            new = ~(codes[i, :table] == codes[j, :table]).any(axis=1)
            i, j = i[new], j[new]
            number += np.bincount(i, copies[j], len(ids)).astype(np.int64)
            if not within:
                number += np.bincount(j, copies[i], len(ids)).astype(np.int64)
    root = ids.copy()
    i, j = np.nonzero(links)
    i, j = left[i], right[j]
    while len(i):
        was = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        if np.array_equal(was, root):
            break
    return number, root


def groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], most: int = 8192) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows sorted by ``names``, many small ones at a time, and where each begins (with the end)."""
    held, n, whole = [], 0, 0

    def cut(table):
        key = np.stack([table.column(c).to_numpy() for c in names])
        return np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0), True])

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= max(most, whole):
            table = pa.Table.from_batches(held).combine_chunks()
            edges = cut(table)
            last = int(edges[-2])
            if last:
                yield table.slice(0, last).combine_chunks(), edges[:-1]
            held, n = table.slice(last).combine_chunks().to_batches(), n - last
            whole = n + most  # the last group may go on: look again after as many rows
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, cut(table)


def _buckets(rows: DataFrame, dim: int, least: float) -> DataFrame:
    """Rows (id, n, root) from rows (bucket, tab, part, side, id, copies, codes, vector), dealt by bucket and part."""

    def run(batches):
        for found, edges in groups(batches, ("tab", "bucket", "part")):
            tab, ids, copies, side = (found.column(c).to_numpy() for c in ("tab", "id", "copies", "side"))
            vectors, codes = found.column("vector"), found.column("codes")
            out = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b - a < 2:
                    continue
                x = unit(_matrix(vectors.slice(a, b - a).combine_chunks(), dim))
                words = np.frombuffer(b"".join(codes.slice(a, b - a).to_pylist()), "<u2").reshape(b - a, -1)
                n, root = compare(ids[a:b], copies[a:b], words, x, side[a:b], int(tab[a]), least)
                use = (n > 0) | (root != ids[a:b])
                out.append(np.stack([ids[a:b][use], n[use], root[use]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.hstack(out)], names=["id", "n", "root"])

    dealt = rows.repartition("tab", "bucket", "part").sortWithinPartitions("tab", "bucket", "part")
    return dealt.mapInArrow(run, "id bigint, n bigint, root bigint")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95, max_sample: int = 20_000, block: int = 2048) -> DataFrame:
    """Per vector: id, n_links, component_id, kept.

    Two vectors are linked if their cosine, in double precision, is at least ``least`` and the tables bring them
    together (recall is measured in the tests).  Null and zero vectors, and those with null or non-finite
    components, and rows without an id, link with nothing; vectors of different length never link.  Equal rows are
    one vector and give one row.  Rotations are learned on the ``max_sample`` points with the least hash.
    Other columns aren't read.  An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embeddings")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).distinct()
    finite = F.forall("vector", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))
    usable = F.coalesce(finite & F.exists("vector", lambda v: v != 0), F.lit(False)) & F.col("id").isNotNull()
    points = scratch.write(
        rows.where(usable).groupBy("vector").agg(F.min("id").alias("point"), F.count("*").alias("copies")).withColumn("dim", F.size("vector")),
        "points",
    )
    found = None
    for dim in [r["dim"] for r in points.select("dim").distinct().collect()]:
        links = _links(points.where(F.col("dim") == dim), scratch, dim, least, max_sample, block)
        found = links if found is None else found.union(links)
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = scratch.write(found, "found")
    roots = components(found.where("root != id").select(F.col("id").alias("a"), F.col("root").alias("b")), scratch, "components")
    number = found.groupBy("id").agg(F.sum("n").alias("n"))
    by_point = (
        points.join(number, F.col("point") == number["id"], "left").drop("id").join(roots, F.col("point") == F.col("node"), "left")
        .select("vector", "point", "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("root", "point").alias("component_id"))
    )
    linked = rows.where(usable).join(by_point, "vector").select("id", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id")
    alone = rows.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    every = linked.union(alone)
    return every.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _links(points: DataFrame, scratch: Scratch, dim: int, least: float, max_sample: int, block: int) -> DataFrame:
    sample = points.orderBy(F.xxhash64("point"), "point").limit(max_sample).select("vector").toArrow().column(0).combine_chunks()
    code = learn_codes(unit(_matrix(sample, dim)), least)

    def encode(batches):
        for batch in batches:
            if batch.num_rows:
                words = strings(unit(_matrix(batch.column("vector"), dim)), code)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in ("point", "copies", "vector")] + [pa.array([w.tobytes() for w in words], pa.binary()), pa.array(list(words.astype(np.int32)))],
                    names=["id", "copies", "vector", "codes", "buckets"],
                )

    coded = scratch.write(
        points.select("point", "copies", "vector").mapInArrow(encode, "id bigint, copies bigint, vector array<double>, codes binary, buckets array<int>"),
        f"coded-{dim}",
    )
    sizes = coded.select("id", F.posexplode("buckets").alias("tab", "bucket"))
    large = sizes.groupBy("tab", "bucket").agg(F.count("*").alias("size")).where(F.col("size") > block)
    blocks = (
        sizes.join(large, ["tab", "bucket"]).groupBy("id")
        .agg(F.map_from_entries(F.collect_list(F.struct("tab", F.ceil(F.col("size") / block).cast("int")))).alias("blocks"))
    )
    cut = coded.join(blocks, "id", "left").select("*", F.posexplode("buckets").alias("tab", "bucket"))
    cut = cut.withColumn("n_blocks", F.coalesce(F.element_at("blocks", F.col("tab")), F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    part = F.least("own", "other").cast("long") * F.col("n_blocks") + F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return _buckets(cut.select("bucket", "tab", part.alias("part"), side.alias("side"), "id", "copies", "codes", "vector"), dim, least)
