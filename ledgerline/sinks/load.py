"""Loads and materialisation."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators.incremental import assert_same_schema
from ledgerline.sinks.files import path_exists

DISPOSITIONS = ("append", "replace")


def snapshot(df: DataFrame, path: str) -> None:
    """Write a table to the lake as Parquet, replacing the previous snapshot."""
    df.write.mode("overwrite").parquet(path)


def load(df: DataFrame, path: str, disposition: str = "append",
         partition_by: Sequence[str] = (), check_schema: bool = True) -> None:
    """Load rows into a Parquet table by write disposition (S7): ``append`` adds the rows
    (versions of a changed row pile up), ``replace`` swaps the table's content.  An
    append must match the existing schema."""
    if disposition not in DISPOSITIONS:
        raise ValueError(f"disposition must be one of {DISPOSITIONS}, or use merge_upsert")
    spark = df.sparkSession
    if disposition == "append" and check_schema and path_exists(spark, path):
        assert_same_schema(df, spark.read.parquet(path))
    w = df.write.mode("append" if disposition == "append" else "overwrite")
    if partition_by:
        # A replace drops the partitions that the new rows don't have, whatever the session says.
        w = w.option("partitionOverwriteMode", "static").partitionBy(*partition_by)
    w.parquet(path)


def load_all(tables: Mapping[str, DataFrame], root: str, disposition: str = "append") -> None:
    """Load several named tables in one run (S8); one write job per table."""
    for name, df in tables.items():
        load(df, f"{root.rstrip('/')}/{name}", disposition)


def materialize(df: DataFrame, name: str, kind: str = "table",
                partition_by: Sequence[str] = (), path: str | None = None,
                unique_key: str | None = None, full_refresh: bool = False) -> DataFrame:
    """Materialise a model (S9-S12): ``view`` registers a temporary view (nothing is
    computed), ``table`` writes it (to ``path`` when given, else as a catalog table) and
    ``incremental`` merges it by ``unique_key`` into the table at ``path``, partitioned by
    its one partition column, or builds that table anew on ``full_refresh``.  The result
    reads the written data, which cuts the lineage."""
    spark: SparkSession = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind == "incremental":
        from ledgerline.operators.merge import merge_upsert, replace_table
        if not path or not unique_key or len(partition_by) != 1:
            raise ValueError("an incremental table needs path, unique_key and one partition column")
        if full_refresh:
            replace_table(spark, path, df, unique_key, partition_by[0])
        else:
            merge_upsert(spark, path, df, unique_key, partition_by[0])
    elif kind == "table":
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.option("partitionOverwriteMode", "static").partitionBy(*partition_by)
        if not path:
            w.saveAsTable(name)
            return spark.table(name)
        w.parquet(path)
    else:
        raise ValueError("kind is 'view', 'table' or 'incremental'")
    out = spark.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out
