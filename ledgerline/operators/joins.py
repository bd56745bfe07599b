"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key that one task may take from the right side before the key is split.
ROWS_PER_TASK = 2_000_000


def _hot_keys(df: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows (``__hk``) and into how many buckets they are split (``__nb``)."""
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__hk")) \
        .agg(F.count(F.lit(1)).alias("__n"))
    return counts.where(F.col("__n") > rows_per_task).select(
        "__hk", F.ceil(F.col("__n") / F.lit(rows_per_task)).cast("int").alias("__nb"))


def _bucket(columns: Sequence[str], buckets: str) -> Column:
    """The bucket of a row, by a hash of all of it; 0 where its key isn't split."""
    return F.when(F.col(buckets).isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.col(buckets)).cast("int"))


def fanout_left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                     rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key``, with hot right keys split.

    AQE can split a skewed LEFT side of a left outer join but never its right side, so a
    right key with billions of rows (e.g. one item name with many versions) would land on
    one task.  Here keys with more than ``rows_per_task`` right rows are hot:

    * right rows of a hot key go to one of ``ceil(n / rows_per_task)`` buckets by a hash
      of the whole row; other keys use bucket 0;
    * left rows of a hot key are copied once per bucket; the join is on (key, bucket);
    * a copy meeting an empty bucket would yield a NULL-padded row; those are dropped,
      which is exact because a hot key always has right rows.

    Each (left, right) pair is produced exactly once.  The extra cost is one grouped count
    of the right keys (partially aggregated) and a join with the small hot-key table.
    The output columns are left's then right's, as in a plain join.
    """
    hot = _hot_keys(right, right_key, rows_per_task)
    lh = left.join(hot, left[left_key] == hot["__hk"], "left").drop("__hk")
    lh = lh.withColumn("__salt", F.explode(F.sequence(F.lit(0),
                                                      F.coalesce(F.col("__nb"), F.lit(1)) - 1)))
    rcols = right.columns
    rh = right.join(hot.withColumnRenamed("__nb", "__rnb"),
                    right[right_key] == hot["__hk"], "left").drop("__hk")
    rh = rh.withColumn("__rsalt", _bucket(rcols, "__rnb"))
    j = lh.join(rh, (lh[left_key] == rh[right_key]) & (lh["__salt"] == rh["__rsalt"]), "left")
    j = j.where(F.col("__nb").isNull() | F.col("__rnb").isNotNull())
    return j.select(*left.columns, *rcols)


def counted_rows(df: DataFrame, key: str, columns: Sequence[str], n: str,
                 rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The distinct ``columns`` of ``df`` (``key`` among them) with the number of its rows as ``n``.

    Rows of a key with more than ``rows_per_task`` rows are split into the buckets of
    ``fanout_left_join`` by a hash of the whole row and counted bucket by bucket; the buckets'
    counts are then added up.  A NULL key is a key like others, in one bucket.
    """
    hot = _hot_keys(df, key, rows_per_task)
    salted = df.join(hot, df[key] == hot["__hk"], "left").withColumn("__salt", _bucket(df.columns, "__nb"))
    per_bucket = salted.groupBy(*columns, "__salt").agg(F.count(F.lit(1)).alias(n))
    return per_bucket.groupBy(*columns).agg(F.sum(n).alias(n))


def fanout_left_join_counted(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                             columns: Sequence[str], n: str,
                             rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``fanout_left_join`` with its equal copies folded: one row for each left row and distinct
    ``columns`` of the matching right rows (``right_key`` among them), with the number of copies
    as ``n`` (1 for a left row without a match).

    Aggregates over the fan-out can be computed from it (``count(*)`` is ``sum(n)``, ``sum(x)`` is
    ``sum(x * n)``) at a cost of left rows times distinct right rows of a key, not times all of them.
    """
    folded = counted_rows(right, right_key, columns, n, rows_per_task)
    j = fanout_left_join(left, folded, left_key, right_key, rows_per_task)
    return j.withColumn(n, F.coalesce(F.col(n), F.lit(1).cast("bigint")))
