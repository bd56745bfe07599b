"""Operator 2: consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``vnodes`` points on a ring of 2^32 places; a key belongs to the first point at or after its
hash.  A shard has a capacity; keys that find it full go on clockwise to the next point whose shard has room.
Going round the ring in order of (hash, key), that is a queue: at each point the keys that arrive there wait
behind those carried on to it, and the first of them fill what room is left.  So the keys of a shard are a few
hundred runs of consecutive ranks on the ring, and the runs follow from the number of keys on each arc alone.
Spark counts the arcs and ranks the keys within their arcs; only the counts (shards x vnodes of them) are
summed up on the driver.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from pyspark.sql.window import Window

RING = 1 << 32


def ring_points(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted places on the ring and the shard of each; a shard's places don't depend on the others."""
    at = [(zlib.crc32(f"shard-{s}/{v}".encode()) * 2654435761 % RING, s) for s in range(shards) for v in range(vnodes)]
    at.sort()
    return np.array([p for p, _ in at], np.int64), np.array([s for _, s in at], np.int64)


def capacities(rows: int, shards: int) -> np.ndarray:
    """Room for all rows, the shards' sizes being at most one apart."""
    return np.array([rows // shards + (s < rows % shards) for s in range(shards)], np.int64)


def fill_ring(counts: np.ndarray, owner: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive ring ranks: first rank, shard, and the slot of the run's first key in its shard.

    ``counts`` has the keys on each arc in ring order.  Ranks count keys from the ring's start.
    """
    room, used = room.copy(), np.zeros(len(room), np.int64)
    waiting: list[list[int]] = []  # queue of [first rank, number]
    runs: list[tuple[int, int, int]] = []
    starts = np.cumsum(counts) - counts
    for turn in range(2):
        for i, s in enumerate(owner):
            if turn == 0 and counts[i]:
                waiting.append([int(starts[i]), int(counts[i])])
            while waiting and room[s] > 0:
                first, n = waiting[0]
                take = min(n, int(room[s]))
                runs.append((first, int(s), int(used[s])))
                room[s] -= take
                used[s] += take
                if take == n:
                    waiting.pop(0)
                else:
                    waiting[0] = [first + take, n - take]
    runs.sort()
    out = np.array(runs, np.int64).reshape(-1, 3)
    return out[:, 0], out[:, 1], out[:, 2]


def bounded_ring(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 24, vnodes: int = 256) -> DataFrame:
    """Every row's shard and slot: key, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``rows``: the shards' row counts are at most one apart.  Slots count from 0 without gaps in each
    shard.  A null text has size 8 and the crc32 of no bytes.  Rows with null or equal keys are ordered by
    their size and crc32, and equal rows get slots of their own.  An empty table gives an empty result.
    """
    places, owner = ring_points(shards, vnodes)

    @F.pandas_udf("int")
    def arc_of(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(places, at.to_numpy()) % len(places)).astype("int32")

    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"), (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32")
    ).withColumn("at", F.pmod(F.xxhash64("key"), F.lit(RING)))
    rows = rows.withColumn("arc", arc_of("at"))
    # The last arc reaches over the ring's end: hashes beyond the last point come before those at its start.
    rows = rows.withColumn("turn", F.when(F.col("at") > int(places[-1]), 0).otherwise(1))

    counts = np.zeros(len(places), np.int64)
    for r in rows.groupBy("arc").count().collect():  # at most shards x vnodes rows
        counts[r["arc"]] = r["count"]
    total = int(counts.sum())
    first, shard_of, slot_of = fill_ring(counts, owner, capacities(total, shards))
    before = np.cumsum(counts) - counts

    @F.pandas_udf("shard int, slot long")
    def place(arc: pd.Series, rank: pd.Series) -> pd.DataFrame:
        r = before[arc.to_numpy()] + rank.to_numpy() - 1
        run = np.searchsorted(first, r, "right") - 1
        return pd.DataFrame({"shard": shard_of[run].astype("int32"), "slot": slot_of[run] + r - first[run]})

    rank = F.row_number().over(Window.partitionBy("arc").orderBy("turn", "at", "key", "size", "text_crc32"))
    placed = rows.withColumn("rank", rank).withColumn("p", place("arc", "rank"))
    return placed.select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("rows").alias("law"), F.col("p.shard").alias("shard"),
        F.col("p.slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
