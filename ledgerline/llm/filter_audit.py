"""Operator 11: what each of several quality filters removes, in every order they could run in.

Four filters look at a document alone and become bits of one number in the scan.  The fifth asks the whole table:
a left-semi join on hash, exact text and smaller id marks the rows whose text an earlier document has.  The ids it
marks are united with those of the other failures, so each document ends as one combination of bits.  Only the
counts of the combinations (at most 32 a part) meet the orders: 120 of them, five steps each.

Large groups of copies: the right side of the join holds one row for each text that occurs under several ids, reduced
within the tasks before anything is shuffled, and is written down first, so that Spark knows its size.  Then it is
either small enough to be sent to the tasks or Spark splits the left side of a hot text over several of them.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame
from pyspark.sql.window import Window

from ledgerline.llm.shared import Scratch

#: The filters, one letter each; a filter's bit is its place here.
FILTERS = "ABCDE"
WORD_GAP = r"[\x20\x09-\x0D]+"
SALTS = 64


def bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def own_failures(text: Column, words: Column, least_words: int, least_distinct: int, most_capitals: int) -> Column:
    """Bits of the filters that look at one document: A few words, B few distinct ones, C capitals, D symbols."""
    distinct = F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = {
        "A": F.size(words) < least_words,
        "B": distinct * F.lit(100).cast("long") < F.size(words) * F.lit(least_distinct).cast("long"),
        "C": capitals * F.lit(100).cast("long") > F.length(text) * F.lit(most_capitals).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }
    return sum((F.when(c, bit(k)).otherwise(0) for k, c in fails.items()), F.lit(0))


def repeated_rows(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``texts`` (id, hash, text, ...) whose very text has a row with a smaller id."""
    firsts = (
        texts.where("id is not null")
        .groupBy("hash", "text")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"))
        .where("first < last")
        .select(F.col("hash").alias("first_hash"), F.col("text").alias("first_text"), "first")
    )
    firsts = scratch.write(firsts, "firsts")
    same = (F.col("hash") == F.col("first_hash")) & (F.col("text") == F.col("first_text"))
    return texts.join(firsts, same & (F.col("first") < F.col("id")), "left_semi")


def combinations(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                 least_words: int = 100, least_distinct: int = 80, most_capitals: int = 10) -> DataFrame:
    """Rows (part, bits, n, good, toxic): documents of a part that fail exactly the filters of ``bits``."""
    scratch = Scratch(docs.sparkSession, "filter-audit")
    texts = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("hash", F.xxhash64("text"))
    words = F.array_remove(F.split("text", WORD_GAP), "")
    own = texts.withColumn("words", words).select(
        "id", "part", "hash", own_failures(F.col("text"), F.col("words"), least_words, least_distinct, most_capitals).alias("bits"),
        F.lit(1).alias("n"), F.lit(0).alias("repeated"),
    )
    marked = repeated_rows(texts, scratch).select("id", "part", "hash", F.lit(0).alias("bits"), F.lit(0).alias("n"), F.lit(1).alias("repeated"))
    # Rows of one id, part and text are alike in all that counts, so they go on as one row with numbers.
    rows = own.unionByName(marked).groupBy("id", "part", "hash").agg(F.max("bits").alias("bits"), F.sum("n").alias("n"), F.sum("repeated").alias("repeated"))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    # A row without an id finds no label; the salt keeps all of them from meeting in one task.
    salt = F.when(F.col("id").isNull(), 1 + F.pmod("hash", F.lit(SALTS))).otherwise(0)
    known = known.select(F.struct(F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("salt")).alias("key"), "good", "toxic")
    rows = rows.withColumn("key", F.struct("id", salt.cast("long").alias("salt"))).join(known, "key", "left").fillna(0, ["good", "toxic"])
    once, again = F.col("n") - F.col("repeated"), F.col("repeated")
    sums = [F.sum(k * w).alias(f"{name}_{i}") for i, k in enumerate((once, again)) for name, w in (("n", F.lit(1)), ("good", F.col("good")), ("toxic", F.col("toxic")))]
    counts = rows.groupBy("part", "bits").agg(*sums)
    both = F.array(*[F.struct((F.col("bits") + i * bit("E")).alias("bits"), *[F.col(f"{c}_{i}").alias(c) for c in ("n", "good", "toxic")]) for i in (0, 1)])
    return counts.select("part", F.explode(both).alias("x")).select("part", "x.*").where("n > 0")


def in_all_orders(counts: DataFrame) -> DataFrame:
    """Every order of the filters and every step of it, for each part of ``counts`` (as from ``combinations``)."""
    letters = ", ".join(f"'{c}'" for c in FILTERS)
    rows = counts.withColumn("filter_order", F.lit(""))
    for _ in FILTERS:
        rows = rows.withColumn("next", F.explode(F.expr(f"filter(array({letters}), x -> instr(filter_order, x) = 0)")))
        rows = rows.withColumn("filter_order", F.concat("filter_order", "next")).drop("next")
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))

    def bit_of(letter: Column) -> Column:
        return sum((F.when(letter == c, bit(c)).otherwise(0) for c in FILTERS), F.lit(0))

    before = sum((F.when(F.col("step") > k, bit_of(F.substring("filter_order", k, 1))).otherwise(0) for k in range(1, len(FILTERS))), F.lit(0))
    rows = rows.withColumn("filter", F.expr("substring(filter_order, step, 1)")).withColumn("own", bit_of(F.col("filter"))).withColumn("before", before)
    fails, gone = F.col("bits").bitwiseAND(F.col("own")) != 0, F.col("bits").bitwiseAND(F.col("before")) != 0

    def total(what: str, where: Column) -> Column:
        return F.sum(F.when(where, F.col(what)).otherwise(0)).cast("long")

    steps = rows.groupBy("part", "filter_order", "step", "filter").agg(
        total("n", ~fails & ~gone).alias("kept"), total("n", fails & ~gone).alias("removed"), total("n", fails & gone).alias("redundant"),
        total("n", F.col("bits") == F.col("own")).alias("unique_fails"), total("good", fails & ~gone).alias("good_lost"),
        total("toxic", fails & ~gone).alias("toxic_lost"),
    )
    return steps.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter"))).drop("filter")


def filter_audit(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per part, order of the filters and step: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley.

    ``options`` are those of ``combinations``.  A null text counts as empty (no words: it fails A alone, and E after the
    first of its kind); a null part is the part ''.  Each row is a document, repeated rows included: rows of one id
    don't make each other fail E.  A row without an id is smaller than none and greater than none, so it neither fails
    E nor makes others fail it, and has no labels.  A document with several label rows is good, or toxic, if one says
    so.  An empty table gives no rows.  Other columns of ``docs`` are not read.
    """
    return in_all_orders(combinations(docs, labels, **options))
