"""High-water marks, cursor loads and schema guards."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.scalar import all_of


class SchemaChanged(ValueError):
    """The new rows' schema differs from the target's (on_schema_change='fail')."""


def high_water(target: DataFrame, col: str) -> Column:
    """max(col) of the target as a scalar subquery (A4).

    Spark runs it once, as its own small job (a partial + final max), when the query that
    uses it executes; on a partition column the filter it feeds prunes partitions.
    """
    return target.select(F.max(col)).scalar()


def high_water_value(target: DataFrame, col: str):
    """max(col) of the target as a Python value (one aggregated row; None when empty).

    Prefer this to ``high_water`` when the mark feeds a scan: a literal in the filter is
    pushed into the Parquet reader (row-group skipping) and prunes partitions, while a
    filter holding a subquery stays above the scan.
    """
    return target.agg(F.max(col).alias("m")).first()["m"]


def newer_than(df: DataFrame, col: str | Column, mark, inclusive: bool = False) -> DataFrame:
    """Rows after the mark: ``col > mark`` (F2) or ``col >= mark``.

    ``mark`` is a Column (e.g. ``high_water``) or a plain value (``high_water_value``).
    A NULL mark (empty target) keeps every row; the source model's filter would keep none.
    """
    c = F.col(col) if isinstance(col, str) else col
    if not isinstance(mark, Column):
        if mark is None:
            return df
        mark = F.lit(mark)
        return df.where((c >= mark) if inclusive else (c > mark))
    keep = (c >= mark) if inclusive else (c > mark)
    return df.where(mark.isNull() | keep)


def incremental_load(source: DataFrame, target: DataFrame, cursor: str,
                     keys: Sequence[str], mark=None) -> DataFrame:
    """Rows of ``source`` not yet loaded into ``target`` by cursor.

    Takes rows with ``cursor >= mark`` (mark = max cursor in the target unless given) and
    drops those whose key was already loaded AT the mark, so a boundary row is neither
    lost nor loaded twice.  The mark is read as a value, so both filters (new rows of the
    source, boundary rows of the target) are literals pushed into the scans; only the
    target's rows on the mark take part in the anti join.  Rows with a NULL cursor cannot
    be placed: split them off with ``null_cursor_rows`` and write them to quarantine first.
    """
    if mark is None:
        mark = high_water_value(target, cursor)
    cand = source.where(F.col(cursor).isNotNull())
    if mark is None:  # empty target: everything is new
        return cand
    m = mark if isinstance(mark, Column) else F.lit(mark)
    on_mark = cand.where(F.col(cursor) == m)  # only these are joined; the rows past the mark need no shuffle
    at_mark = target.where(F.col(cursor) == m).select(
        *[F.col(k).alias(f"__b{i}") for i, k in enumerate(keys)]).distinct()
    cond = all_of(on_mark[k].eqNullSafe(at_mark[f"__b{i}"]) for i, k in enumerate(keys))
    return cand.where(F.col(cursor) > m).unionByName(on_mark.join(at_mark, cond, "left_anti"))


def null_cursor_rows(source: DataFrame, cursor: str, keys: Sequence[str], table: str,
                     parsed: Column | None = None) -> DataFrame:
    """Rows that a cursor load cannot place, in the shape of the load quarantine: table_name,
    row_key, error_message, payload (the whole row as JSON).  ``parsed`` is the cursor's value
    where it is kept as text."""
    rows = source.where((F.col(cursor) if parsed is None else parsed).isNull())
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return rows.select(F.lit(table).alias("table_name"), key.alias("row_key"),
                       F.lit(f"{cursor} is missing or no {'value' if parsed is None else 'date'}")
                       .alias("error_message"),
                       F.to_json(F.struct(*rows.columns)).alias("payload"))


def quarantine_new(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Append the rows that the quarantine table at ``path`` doesn't have yet: a snapshot sends
    them again every hour."""
    from ledgerline.sinks.files import path_exists
    rows = rows.distinct()
    if path_exists(spark, path):
        old = spark.read.parquet(path)
        rows = rows.join(old.select(*rows.columns), rows.columns, "left_anti")
    if not rows.isEmpty():
        rows.write.mode("append").parquet(path)


def cursor_state(targets: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """The cursor of each table as a small (table_name, cursor_column, cursor_value) table
    (I2): the max of the cursor in each loaded target, as text."""
    from functools import reduce
    rows = [t.agg(F.max(c).cast("string").alias("cursor_value"))
             .select(F.lit(name).alias("table_name"), F.lit(c).alias("cursor_column"),
                     "cursor_value")
            for name, (t, c) in targets.items()]
    return reduce(DataFrame.unionByName, rows)


def schema_diff(new, target) -> list[str]:
    """Differences by column name (case-insensitive) and type; column order is ignored
    since a partitioned table's read schema puts partition columns last."""
    a = {f.name.lower(): f.dataType for f in (new.schema if hasattr(new, "schema") else new).fields}
    b = {f.name.lower(): f.dataType for f in (target.schema if hasattr(target, "schema") else target).fields}
    out = [f"missing in new rows: {n}" for n in b if n not in a]
    out += [f"not in target: {n}" for n in a if n not in b]
    out += [f"type of {n}: {a[n].simpleString()} vs {b[n].simpleString()}"
            for n in a if n in b and a[n] != b[n]]
    return out


def assert_same_schema(new, target) -> None:
    """Fail when the new rows' schema differs from the target's."""
    diff = schema_diff(new, target)
    if diff:
        raise SchemaChanged("; ".join(diff))
