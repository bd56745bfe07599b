"""Dashboard and service queries."""

from __future__ import annotations

from functools import reduce
from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.scalar import month_start, to_decimal


def item_quantity(dim_transaction_items: DataFrame, dim_items: DataFrame) -> DataFrame:
    """Total quantity per item name; items with no match group under NULL.

    Eager aggregation: quantities are summed per item_id first (partial + final hash
    aggregate), so the join to items sees one row per item id instead of one per sale
    line, and the fact never shuffles whole.  Summing per id then per name equals the
    join-then-sum of the source query, fan-out included: each id's total is added once
    for every item row that carries it.
    """
    per_id = (dim_transaction_items.groupBy("item_id")
              .agg(F.sum("quantity").alias("__qty")))
    return _by_name(per_id, dim_items)


def _by_name(per_id: DataFrame, dim_items: DataFrame) -> DataFrame:
    """Quantities per item id -> per item name; ids without an item go under NULL.

    Versions of an item with one name are counted first (partial aggregation), and the
    quantity is multiplied by their number: an id with a billion versions is one row.
    """
    items = (dim_items.groupBy(F.col("item_id").alias("__id"), F.col("name").alias("item_name"))
             .agg(F.count(F.lit(1)).alias("__n")))
    j = per_id.join(items, per_id["item_id"] == items["__id"], "left")
    amount = F.col("__qty") * F.coalesce(F.col("__n"), F.lit(1))
    return j.groupBy("item_name").agg(F.sum(amount).alias("total_quantity"))


def quantity_per_item_id(stg_transaction_items: DataFrame, stg_static: DataFrame,
                         stg_items: DataFrame) -> DataFrame:
    """sum(quantity) per item_id of ``dim_transaction_items``, without building it.

    The static half of that model joins each sale to EVERY item row with the sale's name
    (names repeat across item versions), so it holds sales x versions rows.  Summed per
    item id, each static sale adds its quantity once to every item id with its name, so:
    sum static quantities per name first, join those per-name totals to the items by
    name, and add the live lines' per-id sums.  The fan-out is never materialised; a
    static sale whose name matches no item lands in the NULL id, as in the join.
    """
    live = stg_transaction_items.groupBy("item_id").agg(F.sum("quantity").alias("__qty"))
    per_name = stg_static.groupBy("item_name").agg(F.sum("quantity").alias("__qty"))
    names = stg_items.select(F.col("item_id"), F.col("name").alias("__name"))
    # Inner join with the item rows streaming past the per-name totals (one row per name,
    # broadcast by AQE once measured): a name with billions of item rows is no hot task.
    matched = names.join(per_name, names["__name"] == per_name["item_name"], "inner") \
        .select("item_id", "__qty")
    # Names with no item row keep their quantity under a NULL id, as the left join does.
    known = stg_items.select(F.col("name").alias("__name")).distinct()
    unmatched = per_name.join(known, per_name["item_name"] == known["__name"], "left_anti") \
        .select(F.lit(None).cast("bigint").alias("item_id"), "__qty")
    return (live.unionByName(matched).unionByName(unmatched)
            .groupBy("item_id").agg(F.sum("__qty").alias("__qty")))


def item_quantity_from_models(stg_transaction_items: DataFrame, stg_static: DataFrame,
                              stg_items: DataFrame, dim_items: DataFrame) -> DataFrame:
    """``item_quantity`` over the staging models (same result, no fan-out)."""
    per_id = quantity_per_item_id(stg_transaction_items, stg_static, stg_items)
    return _by_name(per_id, dim_items)


def with_share(iq: DataFrame) -> DataFrame:
    """Add each item's share of the total quantity (W2).  The total is a scalar subquery
    over the same aggregate, not a window over all rows (which would put every row in one
    task) and not a cross join."""
    total = iq.select(F.sum("total_quantity").cast("double")).scalar()
    return iq.withColumn("share", F.col("total_quantity").cast("double") / total)


def monthly_sales(fct_transactions: DataFrame) -> DataFrame:
    """Orders and revenue per month, in month order (M11: X4, A2, A3, O1).

    ``total_spent`` is cast to decimal(38,9) before the sum, so the sum is exact and does
    not depend on the order rows arrive in.  count(DISTINCT) is planned as two aggregation
    levels, (month, id) then month, both with map-side partial aggregation, so a month
    holding a third of the rows is pre-reduced in every task before it is shuffled.
    """
    return (fct_transactions
            .groupBy(month_start("transaction_date").alias("month"))
            .agg(F.countDistinct("transaction_id").alias("order_count"),
                 F.sum(to_decimal("total_spent")).alias("total_sales"))
            .orderBy("month"))


def explore(fct_transactions: DataFrame) -> DataFrame:
    """The whole fact for free exploration, date as a timestamp.
    Lazy: nothing is pulled to the driver."""
    return fct_transactions.withColumn("transaction_date",
                                       F.col("transaction_date").cast("timestamp_ntz"))


def count_transactions(transactions: DataFrame) -> DataFrame:
    """Row count as a one-row DataFrame (A5)."""
    return transactions.agg(F.count(F.lit(1)).alias("transaction_count"))


def list_transactions(transactions: DataFrame) -> DataFrame:
    """All transactions."""
    return transactions.select("*")


def get_transactions(transactions: DataFrame, ids: DataFrame,
                     id_col: str = "transaction_id") -> tuple[DataFrame, DataFrame]:
    """Look up a table of ids by primary key (F4): (found rows, missing ids).

    Semi and anti joins: each transaction row is emitted at most once however often its id
    is asked for, and the id list may be as large as the table.
    """
    wanted = ids.select(F.col(id_col).alias("__id")).distinct()
    found = transactions.join(wanted, transactions[id_col] == wanted["__id"], "left_semi")
    missing = wanted.join(transactions.select(F.col(id_col).alias("__tid")),
                          F.col("__id") == F.col("__tid"), "left_anti") \
        .select(F.col("__id").alias(id_col))
    return found, missing


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, several tables in one result (A6).  Each count is a partial +
    final aggregate; the union of one-row results is tiny."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
