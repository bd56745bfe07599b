"""Reset of the OLTP tables."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sinks.files import path_exists

# fixed values: dependency order of the tables, children before parents
RESET_ORDER = ["transaction_items", "transactions", "transactions_static",
               "transactions_errors", "customers", "items", "payment_methods"]


def _count(spark: SparkSession, path: str) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))
    return spark.range(1).select(F.lit(0).cast("bigint").alias("n"))


def reset_tables(spark: SparkSession, root: str,
                 names: Sequence[str] = RESET_ORDER) -> DataFrame:
    """Empty each table under ``root`` (keeping its schema), children first, and return
    (table_name, rows_before, rows_after).  The before-counts are taken first, in one
    small job, since the tables change afterwards."""
    paths = {n: f"{root.rstrip('/')}/{n}" for n in names}
    before = {n: _count(spark, p).collect()[0][0] for n, p in paths.items()}
    for n in names:
        p = paths[n]
        if path_exists(spark, p):
            empty = spark.createDataFrame([], spark.read.parquet(p).schema)
            empty.write.mode("overwrite").parquet(p)
    rows = [_count(spark, p).select(F.lit(n).alias("table_name"),
                                    F.lit(before[n]).cast("bigint").alias("rows_before"),
                                    F.col("n").alias("rows_after"))
            for n, p in paths.items()]
    report = reduce(DataFrame.unionByName, rows)
    return report


def reset_and_reload(spark: SparkSession, root: str, samples: dict,
                     names: Sequence[str] = RESET_ORDER) -> DataFrame:
    """Empty the tables, then append the sample rows of each given table, parents first
    (S14).  Returns the reset report."""
    from ledgerline.sinks.load import load
    report = reset_tables(spark, root, names)
    for name in reversed(list(names)):
        if name in samples:
            load(samples[name], f"{root.rstrip('/')}/{name}", "append")
    return report
