"""Cursor loads that keep their cursor (I1, I2): the mark and the keys on it are committed with the rows.

The next run reads the mark from the table's manifest and the keys on it from a small table beside it; the loaded
rows themselves are not read at all.  Rows and state become visible in one commit, so a run that dies at any point
and is repeated loads every row once.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.scalar import all_of
from ledgerline.sinks.versioned import VersionedTable

CURSOR = "__cursor"
STATE = "cursor"
STATE_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("table_name", "cursor_column", "cursor_value")]
                            + [T.StructField("keys_on_mark", T.LongType()), T.StructField("version", T.LongType())])


def read_state(table: VersionedTable) -> dict | None:
    """{'column', 'type', 'mark' (as text), 'keys' (how many lie on it), 'boundary' (their folders)}, or None."""
    return table.state().get(STATE)


def write_state(column: str, kind: str, mark, keys: int, boundary: Sequence[str]) -> dict:
    """The state to commit with rows; ``mark`` of None stands for a table without any."""
    return {STATE: {"column": column, "type": kind, "mark": None if mark is None else str(mark), "keys": keys,
                    "boundary": list(boundary)}}


def _mark(state: Mapping) -> Column:
    return F.lit(state["mark"]).cast(state["type"])


def new_by_state(table: VersionedTable, source: DataFrame, cursor: str, keys: Sequence[str],
                 parsed: Column | None = None) -> DataFrame:
    """Rows of ``source`` that ``table`` hasn't loaded, by its stored cursor, with the cursor's value as ``__cursor``.

    ``parsed`` is the cursor's value where the column keeps it as text.  Rows without one are left out.
    """
    rows = source.withColumn(CURSOR, F.col(cursor) if parsed is None else parsed).where(F.col(CURSOR).isNotNull())
    state = read_state(table)
    if state is None or state["mark"] is None:
        return rows
    rows = rows.where(F.col(CURSOR) >= _mark(state))
    there = rows.where(F.col(CURSOR) == _mark(state))  # only these are joined; the rows past the mark need no shuffle
    on_mark = table.spark.read.schema(rows.select(*keys).schema).parquet(*[f"{table.path}/{b}" for b in state["boundary"]])
    on_mark = on_mark.select(*[F.col(k).alias(f"__b{i}") for i, k in enumerate(keys)])
    same = all_of(there[k].eqNullSafe(on_mark[f"__b{i}"]) for i, k in enumerate(keys))
    return rows.where(F.col(CURSOR) > _mark(state)).unionByName(there.join(on_mark, same, "left_anti"))


def known_by_state(table: VersionedTable, source: DataFrame, cursor: str, keys: Sequence[str],
                   parsed: Column | None = None) -> int:
    """How many rows of ``source`` the stored cursor counts as loaded: those before the mark, and those on it whose key
    lies there.  Both filters reach the scan of ``source``; the loaded rows are not read."""
    state = read_state(table)
    if state is None or state["mark"] is None:
        return 0
    rows = source.withColumn(CURSOR, F.col(cursor) if parsed is None else parsed)
    on_mark = table.spark.read.schema(rows.select(*keys).schema).parquet(*[f"{table.path}/{b}" for b in state["boundary"]])
    on_mark = on_mark.select(*[F.col(k).alias(f"__b{i}") for i, k in enumerate(keys)])
    there = rows.where(F.col(CURSOR) == _mark(state))
    same = all_of(there[k].eqNullSafe(on_mark[f"__b{i}"]) for i, k in enumerate(keys))
    return rows.where(F.col(CURSOR) < _mark(state)).count() + there.join(on_mark, same, "left_semi").count()


def load_by_state(table: VersionedTable, source: DataFrame, cursor: str, keys: Sequence[str],
                  parsed: Column | None = None, state: Mapping | None = None, before_commit=None) -> int:
    """Append to ``table`` the rows that it hasn't loaded yet; returns their number.

    Their number and largest cursor are measured while they are written, and the keys on it are read from what was
    written.  ``state`` is committed with the cursor's.  Where nothing is new, no version is made.
    """
    old, loaded = read_state(table), 0
    rows = new_by_state(table, source, cursor, keys, parsed)
    kind = rows.schema[CURSOR].dataType.simpleString()
    folder = f"boundary/v{(table.versions() or [0])[-1] + 1:010d}"

    def commit(seen: Mapping, written: DataFrame) -> dict | None:
        nonlocal loaded
        loaded, mark, boundary, n_keys = seen["n"], seen["mark"], [], 0
        if loaded == 0 and table.exists():
            return None
        if mark is not None:
            if old and old["mark"] == mark:
                boundary, n_keys = list(old["boundary"]), old["keys"]
            value, count = F.col(cursor) if parsed is None else parsed, Observation(f"mark-{table.path}")
            on_mark = written.where(value == F.lit(mark).cast(kind)).select(*keys).distinct()
            on_mark.observe(count, F.count(F.lit(1)).alias("n")).write.mode("overwrite") \
                .parquet(f"{table.path}/{folder}")  # a run that died may have left one
            boundary.append(folder)
            n_keys += count.get["n"]
        return {**write_state(cursor, kind, mark, n_keys, boundary), **(state or {})}

    # The cursor's value is observed below the projection that drops it.
    table.append(rows, drop=[CURSOR], state=commit, before_commit=before_commit,
                 observe={"n": F.count(F.lit(1)), "mark": F.max(CURSOR).cast("string")})
    return loaded


def stored_cursors(spark: SparkSession, tables: Mapping[str, VersionedTable]) -> DataFrame:
    """The stored cursor of each table: table_name, cursor_column, cursor_value, keys_on_mark, version."""
    rows = []
    for name, table in tables.items():  # a short list of tables
        m = table.manifest()
        s = m.state.get(STATE) if m else None
        if s:
            rows.append((name, s["column"], s["mark"], s["keys"], m.version))
    return spark.createDataFrame(rows, STATE_SCHEMA)
