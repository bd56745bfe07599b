"""JDBC extract of an OLTP table."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, *, key: str | None = None,
              lower: int | None = None, upper: int | None = None, parts: int = 8,
              predicates: Sequence[str] | None = None, properties: dict | None = None,
              fetch_size: int = 10000, small: bool = False) -> DataFrame:
    """Read a table over JDBC in parallel.

    * numeric key: ``key`` + ``lower``/``upper`` + ``parts`` give ``parts`` range queries;
    * string key (e.g. hex transaction ids): pass ``predicates``, one WHERE clause per
      partition, e.g. from ``hex_ranges("transaction_id", 256)``;
    * neither: a single query, which one task reads; only with ``small=True``.

    Filters and column lists on the result reach the database as WHERE / SELECT lists.
    """
    props = {"fetchsize": str(fetch_size), **(properties or {})}
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=props)
    if key is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs lower and upper bounds of the key")
        return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper,
                               numPartitions=parts, properties=props)
    if not small:
        raise ValueError("give a key with bounds, or predicates, or say small=True")
    return spark.read.jdbc(url, table, properties=props)


def hex_ranges(column: str, parts: int = 256) -> list[str]:
    """WHERE clauses splitting a lower-case hex string key into ``parts`` ranges by its first
    digits, as many as ``parts`` needs.  NULL keys go to the first range."""
    if parts < 1:
        raise ValueError("parts must be 1 or more")
    width = max(1, len(f"{parts - 1:x}"))
    bounds = sorted({f"{i * 16 ** width // parts:0{width}x}" for i in range(1, parts)})
    if not bounds:
        return ["1 = 1"]
    clauses = [f"({column} < '{bounds[0]}' OR {column} IS NULL)"]
    clauses += [f"{column} >= '{lo}' AND {column} < '{hi}'" for lo, hi in zip(bounds, bounds[1:])]
    clauses.append(f"{column} >= '{bounds[-1]}'")
    return clauses
