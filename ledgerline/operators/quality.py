"""Cleaning and validation.

Rules are column expressions over the whole table, evaluated in one pass: each rule gives
a message or NULL, the messages of a row are joined, and the row goes to ``good`` or to
``rejected``.  Nothing is checked row by row in Python.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.scalar import all_of, any_of, messages

# fixed values: the dirty file marks missing data with these exact, case-sensitive words
SENTINELS = ("ERROR", "UNKNOWN")


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def complete_case(cols: Iterable[str], sentinels: Sequence[str] = SENTINELS) -> Column:
    """TRUE when every column is NOT NULL and none equals a sentinel (F1)."""
    return all_of((_q(c).isNotNull() & ~_q(c).isin(*sentinels)) for c in cols)


def drop_sentinels(df: DataFrame, cols: Iterable[str] | None = None,
                   sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """Keep complete cases only.  A narrow filter: no shuffle, pushed into the scan
    where the source supports it."""
    cols = list(cols) if cols is not None else df.columns
    return df.where(complete_case(cols, sentinels))


def validate(df: DataFrame, rules: Sequence[tuple[Column, str]],
             message_col: str = "error_message") -> tuple[DataFrame, DataFrame]:
    """Split ``df`` into (good, rejected) by rules.

    ``rules`` are (failure condition, message) pairs.  ``rejected`` keeps every input
    column plus ``message_col``.  Both outputs come from one projection of the input, so
    good + rejected = input, row for row.
    """
    failed = any_of(F.coalesce(cond, F.lit(False)) for cond, _ in rules)
    # The good side tests the conditions only; messages are built for rejected rows.
    good = df.where(~failed)
    rejected = df.where(failed).withColumn(message_col, messages(*rules))
    return good, rejected


def check_unique(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Keys that occur more than once, with their count.

    A grouped count with map-side partial aggregation: a key held by a third of the rows
    still leaves one partial row per task, so no task sees the hot key's rows.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .where(F.col(count_col) > 1))


def check_fk(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
             parent_keys: Sequence[str] | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent.

    A left anti join.  Only the distinct parent keys travel; the planner broadcasts them
    when their measured size is small and shuffles both sides otherwise.
    """
    parent_keys = list(parent_keys or child_keys)
    pk = parent.select(*[F.col(p).alias(f"__pk{i}") for i, p in enumerate(parent_keys)]).distinct()
    cond = all_of(child[c] == pk[f"__pk{i}"] for i, c in enumerate(child_keys))
    has_key = all_of(child[c].isNotNull() for c in child_keys)
    return child.where(has_key).join(pk, cond, "left_anti")


def subtotal_mismatch(quantity: str = "quantity", unit_price: str = "unit_price",
                      subtotal: str = "subtotal") -> Column:
    """Exact float comparison, as the source rule states it."""
    return F.col(subtotal) != F.col(quantity) * F.col(unit_price)


def check_subtotal(df: DataFrame, **names) -> DataFrame:
    return df.where(subtotal_mismatch(**names))


def integrity_report(unique: Sequence[tuple[str, DataFrame, Sequence[str]]],
                     foreign: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """One row per rule with the number of violations: repeated keys for a unique rule (NULL
    keys don't count), rows without a parent for a reference (R12, R13)."""
    parts = []
    for name, df, keys in unique:
        known = df.where(all_of(F.col(k).isNotNull() for k in keys))
        parts.append(check_unique(known, keys).agg(F.count(F.lit(1)).alias("violations"))
                     .select(F.lit(name).alias("rule"), "violations"))
    for name, child, key, parent, parent_key in foreign:
        parts.append(check_fk(child, parent, [key], [parent_key]).agg(F.count(F.lit(1)).alias("violations"))
                     .select(F.lit(name).alias("rule"), "violations"))
    return reduce(DataFrame.unionByName, parts)
