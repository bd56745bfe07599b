"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from ledgerline.llm.shared import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).distinct()


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Rows (node, root) of all nodes that aren't the least of their component.

    ``links`` has columns a and b of one type, a != b.  Each step shrinks to a table in the scratch folder, so
    that neither the plan nor what a lost executor must redo grows with the number of steps.
    """
    now = scratch.write(links.select("a", "b").distinct(), f"{name}-0")
    mark, step = None, 0
    while not now.isEmpty():
        step += 1
        now = scratch.write(_small_star(_large_star(now)), f"{name}-{step}")
        found = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        scratch.drop(f"{name}-{step - 1}")
        if (found["n"], found["h"]) == mark:
            break
        mark = (found["n"], found["h"])
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
