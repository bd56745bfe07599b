"""Mart models (M7–M9): pass-through dimensions, transaction items with the static
sales attached by item name, and the transaction fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.functions.scalar import to_ts
from ledgerline.operators.incremental import newer_than
from ledgerline.operators.joins import ROWS_PER_TASK, fanout_left_join, fanout_left_join_counted
from ledgerline.operators.latest import latest_by

TI_COLUMNS = S.DIM_TRANSACTION_ITEMS.fieldNames()
FCT_COLUMNS = S.FCT_TRANSACTIONS.fieldNames()


def dim_customers(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select("*")


def dim_items(stg_items: DataFrame) -> DataFrame:
    return stg_items.select("*")


def dim_payment_methods(stg_payment_methods: DataFrame) -> DataFrame:
    return stg_payment_methods.select("*")


def static_items(stg_static: DataFrame, stg_items: DataFrame,
                 dedupe: str | None = None, rows_per_task: int | None = None,
                 copies: str | None = None, found: str | None = None) -> DataFrame:
    """Static sales as transaction items, item id looked up by NAME.

    Item names are not unique, so by default (as in the source model) a sale fans out
    to every item row with its name.  ``dedupe="latest"`` joins only the newest item per
    name instead (ties broken by the larger item_id).

    Plan: an equi-join on the name.  The planner broadcasts the item side when its size
    is known to be small and shuffles both sides otherwise.  A name with a large share of
    the sales is split by AQE on the sales side; a name with very many item rows is
    split by ``fanout_left_join`` (AQE cannot split the right side of a left join).

    Versions of one item id under one name give a sale equal rows.  With ``copies`` those are one
    row, and the column of that name says how many they are; so an aggregate over them needs no
    more rows than there are sales and item ids of their names.  ``found`` names a column that says
    whether an item has the sale's name; it comes with that name, ``item_name``.
    """
    items = stg_items
    if dedupe == "latest":
        items = latest_by(items, ["name"], ["updated_at", "item_id"])
    elif dedupe is not None:
        raise ValueError(f"unknown dedupe mode {dedupe!r}")
    # The whole item row, so that versions of one id under one name fall into many buckets.
    it = items.select(*[F.col(c).alias(f"__{c}") for c in items.columns])
    budget = rows_per_task or ROWS_PER_TASK
    if copies:
        j = fanout_left_join_counted(stg_static, it, "item_name", "__name", ["__name", "__item_id"], copies, budget)
    else:
        j = fanout_left_join(stg_static, it, "item_name", "__name", budget)
    return j.select(
        F.col("transaction_id"),
        F.col("__item_id").alias("item_id"),
        F.col("quantity"),
        F.col("unit_price"),
        F.col("total_spent").alias("subtotal"),
        to_ts("transaction_date").alias("created_at"),
        *([copies] if copies else []),
        *([F.col("__name").isNotNull().alias(found), "item_name"] if found else []),
    )


def dim_transaction_items(stg_transaction_items: DataFrame, stg_static: DataFrame,
                          stg_items: DataFrame, dedupe: str | None = None,
                          rows_per_task: int | None = None) -> DataFrame:
    """UNION ALL of live items and static sales (U1); the static total lands in
    ``subtotal``.  A union adds no shuffle."""
    live = stg_transaction_items.select(*TI_COLUMNS)
    return live.unionByName(static_items(stg_static, stg_items, dedupe, rows_per_task))


def live_facts(stg_transactions: DataFrame, dim_payment_methods: DataFrame,
               mark=None) -> DataFrame:
    """Live transactions with the payment method name.

    ``mark`` (a value or a Column) applies the inclusive high-water filter
    ``date(created_at) >= mark`` (F3).  With a value, Catalyst turns it into a range on the
    timestamp that reaches the scan.
    """
    tx = stg_transactions
    if mark is not None:
        tx = newer_than(tx, F.to_date("created_at"), mark, inclusive=True)
    pm = dim_payment_methods.select(F.col("payment_method_id").alias("__pm_id"),
                                    F.col("name").alias("payment_method_name"))
    j = tx.join(pm, tx["payment_method_id"] == pm["__pm_id"], "left")
    return j.select(
        "transaction_id", "customer_id", "payment_method_name", "location", "total_spent",
        "created_at", "updated_at", F.to_date("created_at").alias("transaction_date"))


def static_facts(stg_static: DataFrame) -> DataFrame:
    """Static sales padded to the fact's columns (P5)."""
    return stg_static.select(
        "transaction_id",
        F.lit(None).cast("bigint").alias("customer_id"),
        F.col("payment_method").alias("payment_method_name"),
        "location",
        "total_spent",
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        "transaction_date",
    )


def fct_transactions(stg_transactions: DataFrame, stg_static: DataFrame,
                     dim_payment_methods: DataFrame, mark=None) -> DataFrame:
    """M9 body: UNION ALL of live and static facts (U2).  ``payment_method_id`` and
    ``status`` are not carried.  For the incremental table use ``merge_upsert`` with
    this as the source (see ``ledgerline.plans.hourly``)."""
    return (live_facts(stg_transactions, dim_payment_methods, mark)
            .unionByName(static_facts(stg_static))
            .select(*FCT_COLUMNS))
