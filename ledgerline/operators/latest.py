"""Latest row per key."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _desc(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_last()


def latest_by(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column],
              rank_col: str | None = None) -> DataFrame:
    """One row per ``keys``: the greatest by ``order_cols`` (descending, NULLs last).

    Put a unique column last in ``order_cols`` for a deterministic pick.  Spark plans
    ``row_number() == 1`` as a WindowGroupLimit, so each task keeps only its local best row
    per key before the shuffle; a key with a third of all rows does not land whole on one
    task.
    """
    w = Window.partitionBy(*keys).orderBy(*[_desc(c) for c in order_cols])
    rn = rank_col or "__rn"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1)
    return out if rank_col else out.drop(rn)
