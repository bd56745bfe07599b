"""Merge (upsert) by unique key into a versioned table, in one commit.

The rows are those of ``merge_upsert``: source rows equal to the target's are left out, and NULL keys never match.
Partitions that hold a key of the source are written anew with the source's rows, all in one generation; partitions that
only gain rows keep their files.  The manifest then swaps all of them at once, emptied ones included, so no reader
sees half a merge or a moved key twice, and a job that dies leaves the table as it was.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.incremental import assert_same_schema
from ledgerline.operators.latest import latest_by
from ledgerline.operators.merge import _distinct_values, _raise_on_duplicates, _unchanged
from ledgerline.sinks.files import staged_rows
from ledgerline.sinks.versioned import VersionedTable


@dataclass
class VersionedMergeResult:
    version: int
    touched: list = field(default_factory=list)   # values of the partitions written or emptied


def merge_versioned(table: VersionedTable, source: DataFrame, key: str, *, on_duplicate: str = "raise",
                    order_cols: Sequence[str] = (), keys_may_move: bool = True, state=None,
                    before_commit=None) -> VersionedMergeResult:
    """Upsert ``source`` into ``table``; a missing table is made from it.

    ``on_duplicate``, ``order_cols`` and ``keys_may_move`` are as in ``merge_upsert``; ``state`` is committed with the
    rows, also where no row changes; ``before_commit`` runs between the write and the commit.
    """
    spark, col = table.spark, table.partition_col
    if on_duplicate == "latest":
        source = latest_by(source, [key], list(order_cols) or [col])
    elif on_duplicate != "raise":
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
    base = table.manifest()
    if base is not None:
        assert_same_schema(source, base.schema)
        source = source.select(*base.schema.fieldNames())
    if base is None and on_duplicate == "latest":  # one pass over the source, nothing to fix it for
        done = table.replace(source, state=state, before_commit=before_commit)
        values = _distinct_values(table.read(version=done.version), col)
        return VersionedMergeResult(done.version, sorted(values, key=lambda v: (v is None, v)))
    with staged_rows(spark, source, "merge-src") as staged:
        if on_duplicate == "raise":
            _raise_on_duplicates(staged, key)
        if base is None:
            values = sorted(_distinct_values(staged, col), key=lambda v: (v is None, v))
            done = table.replace(staged, state=state, before_commit=before_commit)
            return VersionedMergeResult(done.version, values)
        in_source = _distinct_values(staged, col)
        with staged_rows(spark, _unchanged(staged, table.read(in_source, base.version), key), "merge-changed") as changed:
            parts = _distinct_values(changed, col)
            if not parts:
                if before_commit:
                    before_commit()
                return VersionedMergeResult(table.set_state(state).version if state else base.version)
            keys = changed.where(F.col(key).isNotNull()).select(key).distinct()
            # Partitions that hold a key of the source are written anew; the others only gain rows.
            old = table.read(None if keys_may_move else parts, base.version)
            hit = _distinct_values(old.select(key, col).join(keys, key, "left_semi"), col)
            touched = table.read(hit, base.version)
            # NULL keys never match: they stay without going through the join's shuffle.
            kept = (touched.where(F.col(key).isNotNull()).join(keys, key, "left_anti")
                    .unionByName(touched.where(F.col(key).isNull())))
            done = table.replace_folders(kept.unionByName(changed), hit, state=state, before_commit=before_commit, base=base)
            return VersionedMergeResult(done.version, sorted(hit | parts, key=lambda v: (v is None, v)))
