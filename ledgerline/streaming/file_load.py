"""The lake -> raw cursor load as a file stream that stops when caught up (I8).

``readStream`` lists new files in the lake folder; each micro-batch appends the rows that the raw table doesn't have.
``trigger(availableNow=True)`` processes what is there, then stops.

Which rows are loaded is known by two things, neither of which reads the raw table, so a batch costs what its own rows cost:

* one mark for a whole run.  Files of one snapshot come in any order and in any number of micro-batches, so a
  batch's own largest cursor says nothing about the files still to come.  The mark lies in a small table beside the
  stream's checkpoint and moves on only when a run has drained; rows before it are left out by the scan's filter.
* the state of ``dropDuplicatesWithinWatermark`` by (key, cursor), in RocksDB.  Its clock does not tell time but counts
  the marks: rows of the runs since the last mark but one are remembered, however long ago those were, and older ones are
  let go, since the mark keeps them out.  So the state holds what the last runs loaded, not the table.

Of two rows with one key and one cursor the first to come stays.  Rows without a cursor go to the quarantine table, as
in the batch load.

A batch that fails after its write is unknown to the state, and a new checkpoint knows nothing of a table that has rows.
A marker, set before each write and cleared after it, tells the next run so; then, until the mark has moved past
those rows, batches are compared with the raw table's rows from the mark on.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.scalar import all_of
from ledgerline.operators.incremental import (high_water_value, newer_than, null_cursor_rows,
                                              quarantine_new)
from ledgerline.session import session_conf
from ledgerline.sinks.files import _fs, delete_path, path_exists

TICK, REST = "__tick", "__rest"
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def _not_in(rows: DataFrame, loaded: DataFrame, cursor: str, keys: Sequence[str], mark) -> DataFrame:
    """Rows whose (key, cursor) the raw table doesn't have; only its rows from the mark on are compared."""
    at = [*keys, cursor]
    have = newer_than(loaded, cursor, mark, inclusive=True) \
        .select(*[F.col(c).alias(f"__b{i}") for i, c in enumerate(at)]).distinct()
    return rows.join(have, all_of(rows[c].eqNullSafe(have[f"__b{i}"]) for i, c in enumerate(at)), "left_anti")


def new_rows(stream: DataFrame, cursor: str, keys: Sequence[str], mark, ticks: int) -> DataFrame:
    """The stream's rows from the mark on and those without a cursor, each (key, cursor) once.

    ``ticks`` counts the marks so far: it is the state's clock.  Rows without a cursor are told apart by all columns.
    """
    c = F.col(cursor)
    rows = stream if mark is None else stream.where(c.isNull() | (c >= F.lit(mark)))
    whole = F.when(c.isNull(), F.to_json(F.struct(*stream.columns)))
    day = F.timestamp_seconds(F.lit((ticks + 2) * 86_400))  # past the clock's start, which counts as late
    rows = rows.withColumn(TICK, day).withColumn(REST, F.xxhash64(whole))
    return (rows.withWatermark(TICK, "1 day").dropDuplicatesWithinWatermark([*keys, cursor, REST])
            .drop(TICK, REST))


def stream_load(spark: SparkSession, src_dir: str, target_path: str, checkpoint: str,
                schema: T.StructType, cursor: str, keys: Sequence[str],
                max_files_per_trigger: int | None = None, quarantine_path: str | None = None,
                table: str = "stream") -> int:
    """Run the stream until caught up; returns the number of micro-batches.

    ``quarantine_path`` takes the rows without a cursor (by default a folder beside the
    target).
    """
    checkpoint = checkpoint.rstrip("/")
    state_path, running, writing = f"{checkpoint}-mark", f"{checkpoint}-running", f"{checkpoint}-writing"
    torn, torn_drained = f"{checkpoint}-torn", f"{checkpoint}-torn-drained"
    rejects = quarantine_path or f"{target_path.rstrip('/')}_rejected"
    mark, ticks = None, 0
    filled = path_exists(spark, target_path)
    if path_exists(spark, state_path) and filled:
        marks = spark.read.parquet(state_path)  # a row for each run that moved it
        mark, ticks = high_water_value(marks, "mark"), marks.where("mark is not null").distinct().count()
    undrained = path_exists(spark, running)
    if path_exists(spark, writing) or (filled and not path_exists(spark, f"{checkpoint}/commits")):
        _mkdirs(spark, torn)
        delete_path(spark, writing)
    compare = path_exists(spark, torn) or path_exists(spark, torn_drained)
    _mkdirs(spark, running)
    batches, largest = 0, mark

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        nonlocal batches, largest
        batches += 1
        _mkdirs(spark, writing)
        batch.persist()
        try:
            quarantine_new(spark, null_cursor_rows(batch, cursor, keys, table), rejects)
            rows = batch.where(F.col(cursor).isNotNull())
            if compare and path_exists(spark, target_path):
                rows = _not_in(rows, spark.read.parquet(target_path), cursor, keys, mark)
            seen = Observation(f"stream-{epoch_id}")
            rows.observe(seen, F.max(cursor).alias("largest")).write.mode("append").parquet(target_path)
            largest = max((x for x in (largest, seen.get["largest"]) if x is not None), default=None)
        finally:
            batch.unpersist()
        delete_path(spark, writing)

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = new_rows(reader.parquet(src_dir), cursor, keys, mark, ticks)
    with session_conf(spark, STATE_STORE):
        q = (rows.writeStream.foreachBatch(load_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    if (undrained or compare) and path_exists(spark, target_path):
        # A run that failed may have loaded rows past what this one saw.
        largest = high_water_value(spark.read.parquet(target_path), cursor)
    if largest != mark:
        # Marks only grow, so they are appended and the largest counts: no moment without one.
        spark.createDataFrame([(largest,)], T.StructType([T.StructField("mark", schema[cursor].dataType)])) \
            .coalesce(1).write.mode("append").parquet(state_path)
        if path_exists(spark, torn_drained):
            delete_path(spark, torn_drained)  # the rows in doubt are behind the mark now
    if path_exists(spark, torn):
        _mkdirs(spark, torn_drained)
        delete_path(spark, torn)
    delete_path(spark, running)
    return batches
