"""Shared scratch tables: all intermediate data lies under ``spark.checkpoint.dir``."""

from __future__ import annotations

import gc
import tempfile
import uuid

import numpy as np
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder is used, but only by a local master (tests); on a cluster
    each machine would see its own, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-scratch-"))
    return sc.getCheckpointDir().rstrip("/")


class Scratch:
    """A folder of intermediate tables; ``drop`` removes a table once nothing reads it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        scratch_root(spark)
        self.path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, **options) -> DataFrame:
        at = f"{self.path}/{name}"
        df.write.options(**options).parquet(at)
        self.release()
        return self.spark.read.schema(df.schema).parquet(at)

    def release(self) -> None:
        """Let go of the shuffle files of steps that are done: Spark deletes them once the driver has found that
        nothing refers to them, so a long chain of steps needs disk for few of them at a time."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            at.getFileSystem(conf).delete(at, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_names(spark: SparkSession) -> np.ndarray:
    """Numbers of buckets, as many as there are partitions, that ``repartition`` deals to one partition each."""
    n = partitions(spark)
    number = F.col("id").cast("int")
    named = spark.range(64 + 24 * n).groupBy(F.pmod(F.hash(number), F.lit(n)).alias("part")).agg(F.min(number).alias("name"))
    found = {r["part"]: r["name"] for r in named.collect()}
    return np.array([found.get(p, -1 - p) for p in range(n)], np.int32)
