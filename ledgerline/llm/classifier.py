"""Operator 1: quality classifier on random-indexing word vectors.

* Words and runs of punctuation are hashed into ``BUCKETS`` buckets.  Each bucket has a fixed sparse index
  vector; its context vector is the sum of the index vectors of all neighbours within ``WINDOW`` words, over the
  whole corpus.  Tasks sum up integers, so the sums don't depend on the order of tasks.
* A document is the mean and the spread of its words' vectors, with its length and its share of repeated words.
* A two-layer network in numpy is trained on the driver, on at most ``max_train`` labelled documents.  Its
  logits are divided by a temperature that is fitted on a part of them that it wasn't trained on.

Only the text and, for training, the label are read: neither language nor source nor id is an input of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from ledgerline.llm.shared import Scratch
from ledgerline.llm.textbytes import flat, hashes, runs, table
from ledgerline.llm.tokens import by_bytes

BUCKETS, DIMS, NONZERO, WINDOW = 16_384, 32, 2, 2
WIDTH = 2 * DIMS + 2
#: Words are runs of letters (and of all that isn't ASCII), of digits, or of other signs.
_KINDS = table({0: bytes(range(0x21)), 1: b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + bytes(range(0x80, 0x100)), 2: b"0123456789"}, 3)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Of each bucket: the places of its nonzero components and their signs."""
    rng = np.random.default_rng(17)
    places = rng.permuted(np.tile(np.arange(DIMS), (BUCKETS, 1)), axis=1)[:, :NONZERO]
    return places, rng.integers(0, 2, (BUCKETS, NONZERO)) * 2 - 1


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, and where each text's words begin (with the end)."""
    data, ends = flat(texts)
    start, stop, _ = runs(_KINDS[data], ends)
    found = (hashes(data, start, stop) >> np.uint64(20)) % np.uint64(BUCKETS)
    return found.astype(np.int64), np.searchsorted(start, ends)


def context_sums(docs: DataFrame, text_col: str = "text", group_bytes: int = 4 << 20) -> np.ndarray:
    """Sum of the index vectors of all neighbours of each bucket's words, over all documents: BUCKETS x DIMS."""

    def count(batches):
        places, signs = index_vectors()
        cells, weights = np.arange(BUCKETS)[:, None] * DIMS, signs.astype(np.float64)
        total = np.zeros(BUCKETS * DIMS)  # whole numbers
        for batch in batches:
            texts = batch.column(0)
            for a, b in by_bytes(pc.binary_length(texts).to_pylist(), group_bytes):
                words, ends = word_ids(texts.slice(a, b - a))
                doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
                at, near = [], []
                for gap in range(1, WINDOW + 1):
                    same = doc[gap:] == doc[:-gap]
                    left, right = words[:-gap][same], words[gap:][same]
                    at += [left, right]
                    near += [right, left]
                at, near = np.concatenate(at), np.concatenate(near)
                for k in range(NONZERO):
                    total += np.bincount(cells[at, 0] + places[near, k], weights[near, k], BUCKETS * DIMS)
        total = total.astype(np.int64).reshape(BUCKETS, DIMS)
        used = np.flatnonzero(total.any(axis=1))
        yield _as_batch(used, total[used])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for bucket, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                row = np.frombuffer(raw, "<i8")
                total[bucket] = total[bucket] + row if bucket in total else row
        used = np.array(sorted(total), np.int64)
        yield _as_batch(used, np.array([total[b] for b in used.tolist()], np.int64).reshape(len(used), DIMS))

    kind = "bucket bigint, sums binary"
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = texts.mapInArrow(count, kind).repartition("bucket").mapInArrow(add, kind).toArrow()  # at most BUCKETS rows
    out = np.zeros((BUCKETS, DIMS), np.int64)
    for bucket, raw in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
        out[bucket] = np.frombuffer(raw, "<i8")
    return out


def _as_batch(buckets: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int64()), pa.array([x.astype("<i8").tobytes() for x in sums], pa.binary())], names=["bucket", "sums"]
    )


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Each bucket's own direction and that of its contexts, added."""
    places, signs = index_vectors()
    own = np.zeros((BUCKETS, DIMS), np.float32)
    np.put_along_axis(own, places, signs.astype(np.float32) / np.sqrt(NONZERO), axis=1)
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    return own + (sums / np.maximum(norm, 1)).astype(np.float32)


def pool(texts: pa.Array, wide: np.ndarray) -> np.ndarray:
    """One row of WIDTH numbers per text; zeros for a text without words.  ``wide``: word vectors and their squares."""
    words, ends = word_ids(texts)
    n = np.diff(ends)
    doc = np.repeat(np.arange(len(n)), n)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    out = np.zeros((len(n), WIDTH), np.float32)
    for a in range(0, len(n), 200):
        b = min(a + 200, len(n))
        span = slice(ends[a], ends[b])
        counts = np.bincount((doc[span] - a) * BUCKETS + words[span], minlength=(b - a) * BUCKETS)
        found = counts.reshape(b - a, BUCKETS).astype(np.float32) @ wide / np.maximum(n[a:b], 1)[:, None]
        mean, square = found[:, :DIMS], found[:, DIMS:]
        out[a:b, :DIMS], out[a:b, DIMS:-2] = mean, np.sqrt(np.maximum(square - mean * mean, 0))
    out[:, -2] = np.log1p(n)
    out[:, -1] = np.bincount(doc, again, len(n)) / np.maximum(n, 1)
    return out


def pooled(docs: DataFrame, vectors: np.ndarray, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = 1 << 20) -> DataFrame:
    """Rows of doc_id and the document's vector (32-bit floats as bytes)."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)  # BUCKETS x DIMS numbers of 4 bytes, 4 MB

    def run(batches):
        wide = np.hstack([shared.value, shared.value**2])
        for batch in batches:
            texts = batch.column(1)
            for a, b in by_bytes(pc.binary_length(texts).to_pylist(), group_bytes):
                found = pool(texts.slice(a, b - a), wide)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([x.tobytes() for x in found], pa.binary())], names=["doc_id", "vector"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, vector binary")


@dataclass
class Network:
    """Standardised inputs, one hidden layer of rectifiers, a logit, and a temperature."""

    centre: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum((x - self.centre) / self.scale @ w1 + b1, 0) @ w2 + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def constant(share: float) -> Network:
    """For labels of one kind, or none: the smoothed share of label 1, whatever the input."""
    w = [np.zeros((WIDTH, 1)), np.zeros(1), np.zeros(1), np.array([np.log(share / (1 - share))])]
    return Network(np.zeros(WIDTH), np.ones(WIDTH), w)


def train(x: np.ndarray, y: np.ndarray, hidden: int = 48, epochs: int = 60, batch: int = 128, rate: float = 2e-3, decay: float = 1e-4, seed: int = 5) -> Network:
    """Adam on the log loss over four fifths of the rows; the temperature is fitted on the others."""
    if len(y) < 10 or len(np.unique(y)) < 2:
        return constant((y.sum() + 1) / (len(y) + 2))
    rng = np.random.default_rng(seed)
    held = np.arange(len(y)) % 5 == 4
    tx, ty = x[~held].astype(np.float64), y[~held].astype(np.float64)
    net = Network(tx.mean(0), tx.std(0) + 1e-3, [
        rng.normal(0, np.sqrt(2 / WIDTH), (WIDTH, hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), hidden), np.zeros(1),
    ])
    tx = (tx - net.centre) / net.scale
    m, v, step = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights], 0
    for epoch in range(epochs):
        order = rng.permutation(len(ty))
        pace = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for at in range(0, len(ty), batch):
            rows = order[at : at + batch]
            w1, b1, w2, b2 = net.weights
            h = np.maximum(tx[rows] @ w1 + b1, 0)
            miss = (1 / (1 + np.exp(-np.clip(h @ w2 + b2[0], -50, 50))) - ty[rows]) / len(rows)
            back = np.outer(miss, w2) * (h > 0)
            grads = [tx[rows].T @ back + decay * w1, back.sum(0), h.T @ miss + decay * w2, np.array([miss.sum()])]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                net.weights[i] = net.weights[i] - pace * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    z, t = net.logits(x[held].astype(np.float64)), y[held]
    grid = np.geomspace(0.5, 20, 200)
    loss = [np.mean(np.logaddexp(0, np.where(t == 1, -z, z) / g)) for g in grid]
    net.temperature = float(grid[int(np.argmin(loss))])
    return net


def score_quality(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_train: int = 20_000
) -> DataFrame:
    """Every row's id, score (0 to 1, higher: label 1 likelier) and predicted (1 if score >= 0.5, else 0).

    ``learn`` says, as a condition on the id column, which labelled documents may be learned from; of those, the
    ``max_train`` with the least hash of id and text vector are taken.  Null and empty texts get the score of a document
    without words; null ids are scored; equal rows get equal scores; labels other than 0 and 1 are ignored; with
    no usable labels all scores are 0.5.  Other columns aren't read.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    vectors = word_vectors(context_sums(docs, text_col))
    found = Scratch(spark, "classifier").write(pooled(docs, vectors, id_col, text_col), "pooled")
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).where("label in (0, 1)").where(learn).distinct()
    sample = (
        found.join(marked, "doc_id").orderBy(F.xxhash64("doc_id"), F.xxhash64("vector"), "label").limit(max_train).select("vector", "label").toArrow()
    )
    x = np.frombuffer(b"".join(sample.column(0).to_pylist()), np.float32).reshape(-1, WIDTH)
    net = train(x, sample.column(1).to_numpy().astype(np.int64)) if len(x) else constant(0.5)

    def score(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32).reshape(-1, WIDTH)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(net.score(x.astype(np.float64)))], names=["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = found.mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select(F.col("doc_id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
