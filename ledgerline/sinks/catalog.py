"""Tables of the session catalog (S6, S9, S10, S13): versioned tables published under a name.

A versioned table is read through its manifest; whoever asks by name (``spark.table``, SQL) reads the catalog table that
``publish`` keeps up.  The published version is a property of that table, so a publish writes only the partitions
that have changed since, with ``INSERT OVERWRITE`` by dynamic partition, and drops those that are gone.  A catalog
table is changed in place: it has no versions of its own.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import session_conf
from ledgerline.sinks.versioned import VersionedTable

VERSION = "ledgerline.version"


def _name(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def create_database(spark: SparkSession, database: str, location: str) -> None:
    """A database whose managed tables lie under ``location``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")


def published_version(spark: SparkSession, database: str, table: str) -> int | None:
    if not spark.catalog.tableExists(f"{database}.{table}"):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {_name(database, table)}").where(F.col("key") == VERSION).collect()
    return int(rows[0]["value"]) if rows else None


def publish(source: VersionedTable, database: str, table: str) -> list[str]:
    """Bring the catalog table up to the latest version; returns the partitions that were written or dropped."""
    spark, col = source.spark, source.partition_col
    name, m, have = _name(database, table), source.manifest(), published_version(source.spark, database, table)
    changed = source.changed_since(have) if have is not None else None
    if changed is None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        w = source.read(version=m.version).write.format("parquet")
        (w.partitionBy(col) if col else w).saveAsTable(f"{database}.{table}")
        changed = m.folders()
    elif changed:
        rows = source.rows_of([s for s in m.slices if s.folder in changed], m.schema)
        gone = sorted(changed - m.folders()) if col else []
        before = set(partitions(spark, database, table)) if col else set()
        # INSERT goes by place: the partition column is the table's last.
        columns = [*[c for c in m.schema.fieldNames() if c != col], *([col] if col else [])]
        with session_conf(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            rows.select(*[F.col(f"`{c}`") for c in columns]).write.insertInto(f"{database}.{table}", overwrite=True)
        for folder in gone:
            if folder in before:
                drop_partition(spark, database, table, folder)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{VERSION}' = '{m.version}')")
    return sorted(changed)


def partitions(spark: SparkSession, database: str, table: str) -> list[str]:
    """The partitions of a catalog table as its folders are called."""
    return [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {_name(database, table)}").collect()]


def drop_partition(spark: SparkSession, database: str, table: str, folder: str) -> None:
    column, value = folder.split("=", 1)
    value = value.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {_name(database, table)} DROP IF EXISTS PARTITION (`{column}` = '{value}')")


def save_tables(spark: SparkSession, database: str, tables: Mapping[str, DataFrame]) -> None:
    """Write several tables into a database."""
    for name, df in tables.items():
        df.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")


def truncate_tables(spark: SparkSession, database: str, names: Sequence[str]) -> DataFrame:
    """Empty tables in the given order, which keeps their schemas; (table_name, rows_before, rows_after)."""
    rows = []
    for n in names:
        before = spark.table(f"{database}.{n}").count()
        spark.sql(f"TRUNCATE TABLE {_name(database, n)}")
        rows.append((n, before, spark.table(f"{database}.{n}").count()))
    return spark.createDataFrame(rows, "table_name string, rows_before bigint, rows_after bigint")
