"""File-system helpers through Spark's own Hadoop file system (works for local paths,
HDFS and object stores alike)."""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


# fixed values: characters that Spark escapes in the folder names of partitions
_ESCAPED = set('"#%\'*/:=?\\\x7f{[]^') | {chr(c) for c in range(1, 0x20)}


def partition_folder(col: str, v) -> str:
    """The folder name ``col=value`` as Spark's writer spells it."""
    if v is None or v == "":
        text = "__HIVE_DEFAULT_PARTITION__"
    elif isinstance(v, dt.datetime):
        text = v.strftime("%Y-%m-%d %H:%M:%S") + (f".{v.microsecond:06d}".rstrip("0") if v.microsecond else "")
    elif isinstance(v, bool):
        text = str(v).lower()
    else:
        text = v.isoformat() if isinstance(v, dt.date) else str(v)
    return "=".join("".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in x) for x in (col, text))


def remove_partitions(spark: SparkSession, root: str, col: str, values: Iterable) -> None:
    """Delete the folders ``root/col=value`` of a partitioned table; each must exist."""
    for v in values:
        fs, top = _fs(spark, root.rstrip("/"))
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(top, partition_folder(col, v))
        if not fs.exists(p):
            raise FileNotFoundError(f"{root} has no partition folder for {col} = {v!r}")
        fs.delete(p, True)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


@contextmanager
def staged_rows(spark: SparkSession, df: DataFrame, label: str):
    """Write ``df`` once as Parquet under the shared scratch folder and yield a DataFrame
    over the written files; delete them on exit.

    This fixes the rows (nondeterministic columns keep their values), cuts the lineage,
    and lets later steps re-read the rows instead of recomputing them.  The folder lives
    under ``spark.checkpoint.dir``, which a cluster points at shared storage, so a lost
    executor loses nothing.
    """
    from ledgerline.session import scratch_path
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    try:
        yield spark.read.parquet(path)
    finally:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
