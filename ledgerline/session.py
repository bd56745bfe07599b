"""Session helpers.

Library code never creates or reconfigures the session it is given; these helpers are
for tests, the bench and command-line use.  The only setting the library reads is
``spark.checkpoint.dir`` (shared scratch space), and it sets one only when the session
has none, which is the case in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale, applied to sessions built here.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    # AQE: coalesce small shuffle partitions, split skewed join partitions, and turn a
    # sort-merge join into a broadcast join only when the measured side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    # Listing a table with many date folders runs as a Spark job; one task per folder
    # (the default allows 10,000) is far too fine: cap it at a few tasks per core.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
    "spark.sql.parquet.compression.codec": "zstd",
}


# Suggested settings for a large cluster (not applied by any code here; the platform or
# the job submitter sets them).  Shuffle partitions start high and AQE coalesces them to
# about the advisory size, so a 100 TB job neither spills nor runs thousands of empty
# tasks; skewed join partitions over the threshold are split.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "1000",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    """Build (or get) a session with the defaults above, for tests and the bench."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app_name).master(master or f"local[{cpus}]")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def session_conf(spark: SparkSession, conf: dict):
    """Settings that Spark takes from the session alone when a query starts, put back afterwards."""
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared scratch root named by ``spark.checkpoint.dir``.

    On a cluster the platform sets it to a shared folder, and it is used as is; a cluster
    without it is an error, since every executor would write to a disk of its own.  A local
    session (tests) that has none gets a fresh local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-ckpt-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared scratch root for one job's tables."""
    root = ensure_checkpoint_dir(spark)
    return f"{root}/ledgerline/{label}-{uuid.uuid4().hex[:12]}"
