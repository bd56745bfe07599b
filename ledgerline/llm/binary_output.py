"""Operator 6: token ids as Parquet list columns, in ascending id order, and reads of them.

The files hold one row per document: id, part, start_in_part, n_tokens, ids.  The list of ids is dictionary
encoded, the metadata columns delta encoded; row groups and pages are kept small, and each file carries page
indexes, so that a read of a few columns or of a range of ids touches only the pages that it needs.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.window import Window

from ledgerline.llm.shared import Scratch, partitions
from ledgerline.llm.tokens import by_bytes, encoder

_META = ("doc_id", "part", "start_in_part", "n_tokens")


def format_options(row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10, page_rows: int = 1000) -> dict[str, str]:
    """Writer options; Parquet's writer adds column and offset indexes by itself."""
    return {
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.enable.dictionary": "true",
    } | {f"parquet.enable.dictionary#{c}": "false" for c in _META}


def encoded(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = 4 << 20) -> DataFrame:
    """Rows in ascending id order over the partitions: doc_id, start_in_part, n_tokens, ids, part.

    A null text is empty (its only id is ``end_id``); null ids come first; rows of one id are ordered by a
    hash of their text, and may lie in neighbouring partitions, so that a very common id is no single task's.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = (
        rows.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(partitions(spark), "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
    )

    def encode(batches):
        enc, start = encoder(path), 0
        for batch in batches:
            texts = batch.column(1)
            for a, b in by_bytes(pc.binary_length(texts).to_pylist(), group_bytes):
                ids, sizes = enc.ids_of_group(texts.slice(a, b - a), end_id)
                ends = np.cumsum(sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(start + ends - sizes), pa.array(sizes), lists],
                    names=["doc_id", "start_in_part", "n_tokens", "ids"],
                )
                start += int(ends[-1])

    return ordered.mapInArrow(
        encode, f"doc_id {kind}, start_in_part bigint, n_tokens bigint, ids array<int>"
    ).withColumn("part", F.spark_partition_id())


def part_starts(files: DataFrame) -> DataFrame:
    """Tokens before each part; reads only two metadata columns.  One row per written part."""
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("part_start"))


def read_digests(files: DataFrame) -> DataFrame:
    """From the files: doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned integers)."""

    def digest(batches):
        for batch in batches:
            lists = batch.column(3)
            ends = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False))).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "part", "start_in_part", "n_tokens", "ids_crc32"],
            )

    kind = files.schema["doc_id"].dataType.simpleString()
    rows = files.select("doc_id", "part", "start_in_part", "ids").mapInArrow(
        digest, f"doc_id {kind}, part int, start_in_part bigint, n_tokens bigint, ids_crc32 bigint"
    )
    # One row per written part, of which there are as many as shuffle partitions.
    placed = rows.join(F.broadcast(part_starts(files)), "part")
    return placed.select("doc_id", (F.col("part_start") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")


def write_ids(docs: DataFrame, path: str, end_id: int, out: str, **columns) -> None:
    encoded(docs, path, end_id, **columns).write.options(**format_options()).parquet(out)


def read_ids(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out)


def round_trip(docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Write the files into the shared scratch folder and return what a reader finds in them."""
    spark = docs.sparkSession
    out = f"{Scratch(spark, 'token-ids').path}/ids"
    write_ids(docs, path, end_id, out)
    return read_digests(read_ids(spark, out))
