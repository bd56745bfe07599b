"""Merge (upsert) by unique key into a date-partitioned Parquet table.

Plain Parquet has no row-level MERGE, so the merge rewrites only the partitions it
touches:

1. fix the source once (written as Parquet under the shared ``spark.checkpoint.dir``,
   which also cuts its lineage) and check it has one row per non-NULL key (or keep the
   latest row per key when asked); drop rows identical to the target's;
2. ``hit`` = partitions of the source, plus partitions of target rows whose key is in the
   source (a key may move to another date);
3. ``out`` = target rows in ``hit`` whose key is not in the source, plus the source;
4. write ``out`` with dynamic partition overwrite (only partitions that receive rows are
   replaced, all in one job commit), then remove the partitions of ``hit`` that end up
   with no rows.

The sets of partition values (dates touched by one increment) are the only things
brought to the driver; every read of the target is pruned to them.

NULL keys never match, on either side, as in SQL MERGE.  The cost is the touched
partitions plus one scan of the target's key column (skipped with
``keys_may_move=False``).  The write and the removal of emptied partitions are two steps:
a reader in between can see a moved key twice.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.scalar import all_of
from ledgerline.operators.incremental import assert_same_schema
from ledgerline.operators.latest import latest_by
from ledgerline.operators.quality import check_unique
from ledgerline.sinks.files import path_exists, remove_partitions, staged_rows


# More folders than this in one increment mean that the column is no partition column.
MAX_PARTITIONS = 100_000


class DuplicateKeys(ValueError):
    """The source holds more than one row for a key."""


@dataclass
class MergeResult:
    touched_partitions: int
    removed_partitions: list


def _unchanged(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows with no identical target row (NULL-safe on every other column).  A row
    without a key is always new: NULL keys never match."""
    cols = source.columns
    t = target.where(F.col(key).isNotNull()).select(*[F.col(c).alias(f"__t_{c}") for c in cols])
    cond = all_of((source[c] == t[f"__t_{c}"]) if c == key
                  else source[c].eqNullSafe(t[f"__t_{c}"]) for c in cols)
    return source.join(t, cond, "left_anti")


def _in_parts(df: DataFrame, col: str, values) -> DataFrame:
    """Static partition filter for a short list of values (NULL partition included)."""
    vals = [v for v in values if v is not None]
    cond = F.col(col).isin(vals) if vals else F.lit(False)
    if any(v is None for v in values):
        cond = cond | F.col(col).isNull()
    return df.where(cond)


def _distinct_values(df: DataFrame, col: str) -> set:
    # The distinct partition values of a merge: dates touched by one increment, a short
    # list however many rows the increment has.  Each is a folder of the table, so a column
    # with more values than a table may have folders is refused, not collected.
    values = df.select(col).distinct().limit(MAX_PARTITIONS + 1).collect()
    if len(values) > MAX_PARTITIONS:
        raise ValueError(f"{col} has more than {MAX_PARTITIONS} values: not a partition column")
    return {r[0] for r in values}


def merge_upsert(spark: SparkSession, target_path: str, source: DataFrame, key: str,
                 partition_col: str, *, on_duplicate: str = "raise",
                 order_cols: Sequence[str] = (), skip_unchanged: bool = True,
                 keys_may_move: bool = True, check_schema: bool = True) -> MergeResult:
    """Upsert ``source`` into the partitioned Parquet table at ``target_path``.

    A missing target is created from the source.  ``on_duplicate``: ``"raise"`` (as a
    warehouse MERGE does) or ``"latest"`` (keep the greatest row per key by
    ``order_cols``).  ``skip_unchanged`` drops source rows equal to a target row first,
    so re-sent rows rewrite no partition.  ``keys_may_move=False`` promises a key never
    changes partition and skips the scan of the target's key column.
    """
    if on_duplicate == "latest":
        source = latest_by(source, [key], list(order_cols) or [partition_col])
    elif on_duplicate != "raise":
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")

    if not path_exists(spark, target_path):
        with staged_rows(spark, source, "merge-src") as staged:
            if on_duplicate == "raise":
                _raise_on_duplicates(staged, key)
            _write_partitions(staged, partition_col, target_path)
        return MergeResult(touched_partitions=-1, removed_partitions=[])

    target = spark.read.parquet(target_path)
    if check_schema:
        assert_same_schema(source, target)
    source = source.select(*target.columns)

    with staged_rows(spark, source, "merge-src") as staged:
        if on_duplicate == "raise":
            _raise_on_duplicates(staged, key)
        src_parts = _distinct_values(staged, partition_col)
        if skip_unchanged:
            with staged_rows(spark, _unchanged(staged, _in_parts(target, partition_col, src_parts), key),
                             "merge-changed") as changed:
                return _merge_staged(spark, target_path, target, changed, key, partition_col,
                                     keys_may_move)
        return _merge_staged(spark, target_path, target, staged, key, partition_col,
                             keys_may_move)


def _merge_staged(spark, target_path, target, source, key, partition_col, keys_may_move):
    src_parts = _distinct_values(source, partition_col)
    if not src_parts:  # nothing to merge: no scan of the target's keys
        return MergeResult(touched_partitions=0, removed_partitions=[])
    keys = source.where(F.col(key).isNotNull()).select(key).distinct()
    hit = set(src_parts)
    if keys_may_move:
        # Key and partition columns only: a narrow, column-pruned scan of the target.
        hit |= _distinct_values(target.select(key, partition_col).join(keys, key, "left_semi"),
                                partition_col)
    if not hit:
        return MergeResult(touched_partitions=0, removed_partitions=[])
    touched = _in_parts(target, partition_col, hit)
    # NULL keys never match: keep those rows without sending them through the join's
    # shuffle, where they would all hash to one task.
    kept = (touched.where(F.col(key).isNotNull()).join(keys, key, "left_anti")
            .unionByName(touched.where(F.col(key).isNull())))
    # Partitions of hit that will hold no row, known before the write changes the target.
    removed = sorted(hit - src_parts - _distinct_values(kept, partition_col),
                     key=lambda v: (v is None, v))
    _write_partitions(kept.unionByName(source), partition_col, target_path)
    remove_partitions(spark, target_path, partition_col, removed)
    return MergeResult(touched_partitions=len(hit), removed_partitions=removed)


def replace_table(spark: SparkSession, path: str, source: DataFrame, key: str,
                  partition_col: str) -> None:
    """Build the partitioned table anew from ``source`` (full refresh): partitions that the
    source no longer has go too.  The source is written aside first, so it may read the table."""
    with staged_rows(spark, source, "refresh") as staged:
        _raise_on_duplicates(staged, key)
        (_by_partition(staged, partition_col).write.mode("overwrite")
            .option("partitionOverwriteMode", "static").partitionBy(partition_col).parquet(path))


def _write_partitions(df: DataFrame, partition_col: str, path: str) -> None:
    """Dynamic partition overwrite: only partitions that receive rows are replaced, in one
    job commit; a failed or retried task leaves the table as it was."""
    (_by_partition(df, partition_col).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col).parquet(path))


def _by_partition(df: DataFrame, partition_col: str) -> DataFrame:
    """Group rows by partition value before a partitioned write, so each date gets a few
    files instead of one per task.  REBALANCE lets AQE split a date that holds a large
    share of the rows over several tasks and merge small dates together."""
    return df.hint("rebalance", partition_col)


def _raise_on_duplicates(source: DataFrame, key: str) -> None:
    dups = check_unique(source.where(F.col(key).isNotNull()), [key])
    if not dups.isEmpty():
        sample = [r[0] for r in dups.limit(5).collect()]
        raise DuplicateKeys(f"source has repeated {key} values, e.g. {sample}")
