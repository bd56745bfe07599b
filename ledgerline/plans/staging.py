"""Staging models (M1–M6): explicit column lists, full-row distinct, and the cleaning of
the dirty historical sales file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.functions.scalar import any_of, messages, to_date_safe, to_double, to_long
from ledgerline.operators.incremental import newer_than
from ledgerline.operators.quality import complete_case, validate

# Column list of each staging model (drops load-tool bookkeeping columns).
STAGING_COLUMNS = {
    "customers": ["customer_id", "name", "email", "created_at", "updated_at"],
    "items": ["item_id", "name", "description", "unit_price", "created_at", "updated_at"],
    "payment_methods": ["payment_method_id", "name", "is_active", "created_at"],
    "transactions": ["transaction_id", "customer_id", "payment_method_id", "total_spent",
                     "location", "status", "created_at", "updated_at"],
    "transaction_items": ["transaction_id", "item_id", "quantity", "unit_price", "subtotal",
                          "created_at"],
}


def stage(df: DataFrame, table: str) -> DataFrame:
    """P1 + A7.  The distinct is one shuffle on all columns; partial aggregation removes
    repeats inside each task first, so a row copied a billion times costs one row per
    task in the exchange."""
    return df.select(*STAGING_COLUMNS[table]).distinct()


def stg_customers(customers: DataFrame) -> DataFrame:
    return stage(customers, "customers")


def stg_items(items: DataFrame) -> DataFrame:
    return stage(items, "items")


def stg_payment_methods(payment_methods: DataFrame) -> DataFrame:
    return stage(payment_methods, "payment_methods")


def stg_transactions(transactions: DataFrame) -> DataFrame:
    return stage(transactions, "transactions")


def stg_transaction_items(transaction_items: DataFrame) -> DataFrame:
    return stage(transaction_items, "transaction_items")


# --- the dirty static sales (M6) -------------------------------------------------------

def _q(name: str) -> Column:
    return F.col(f"`{name}`")


# Typed columns of the static model, from the CSV's text columns.
# try_cast, not cast: with ANSI on, casting a dirty value would fail the whole job.
def _typed_columns(prefix: str = "") -> list[Column]:
    return [
        _q("Transaction ID").alias(prefix + "transaction_id"),
        _q("Item").alias(prefix + "item_name"),
        to_long(_q("Quantity")).alias(prefix + "quantity"),
        to_double(_q("Price Per Unit")).alias(prefix + "unit_price"),
        to_double(_q("Total Spent")).alias(prefix + "total_spent"),
        _q("Location").alias(prefix + "location"),
        _q("Payment Method").alias(prefix + "payment_method"),
        to_date_safe(_q("Transaction Date")).alias(prefix + "transaction_date"),
    ]


STATIC_COLUMNS = S.STG_TRANSACTIONS_STATIC.fieldNames()
_P = "__t_"  # raw and typed columns differ only in case, and Spark names ignore case


def parse_rules(prefix: str = "") -> list[tuple[Column, str]]:
    c = lambda n: F.col(prefix + n)
    return [
        (c("quantity").isNull(), "Quantity is not an integer"),
        (c("unit_price").isNull(), "Price Per Unit is not a number"),
        (c("total_spent").isNull(), "Total Spent is not a number"),
        (c("transaction_date").isNull(), "Transaction Date is not a date"),
    ]


def clean_static(raw: DataFrame, mark=None,
                 inclusive: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split the raw sales file into (typed complete cases, rejected raw rows).

    Rows with a sentinel or NULL are dropped (F1), as in the source model.  Rows that pass
    F1 but hold a value that does not parse (``'4.0'`` as a quantity, ``'abc'`` as a
    date) would fail the source job; here they go to ``rejected`` with a message.
    ``mark`` (a value, or a Column such as a scalar subquery on the target) applies the
    high-water filter ``transaction_date > mark`` (F2; ``>=`` with ``inclusive``); a
    NULL mark loads everything.  One narrow pass: no shuffle.
    """
    complete = raw.where(complete_case(S.SALES_CSV_COLUMNS))
    both = complete.select("*", *_typed_columns(_P))
    good, rejected = validate(both, parse_rules(_P))
    good = good.select(*[F.col(_P + c).alias(c) for c in STATIC_COLUMNS])
    rejected = rejected.select(*[_q(c) for c in S.SALES_CSV_COLUMNS], "error_message")
    if mark is not None:
        good = newer_than(good, "transaction_date", mark, inclusive)
    return good, rejected


def stg_transactions_static(raw: DataFrame, mark=None) -> DataFrame:
    """M6: complete, typed, de-duplicated static sales.  The rows that don't parse are
    ``rejected_static``."""
    good, _ = clean_static(raw, mark)
    return good.distinct()


def rejected_static(raw: DataFrame) -> DataFrame:
    """The complete rows that don't parse, in the columns of the raw static table, with a
    message (S15)."""
    from ledgerline.plans.imports import CSV_TO_STATIC
    _, rejected = clean_static(raw)
    return rejected.select(*[_q(src).alias(dst) for src, dst in CSV_TO_STATIC.items()],
                           "error_message").select(*S.TRANSACTIONS_STATIC.fieldNames(), "error_message")


def with_fates(raw: DataFrame, rejected: str | None = None) -> DataFrame:
    """The seed's rows typed, each with its ``fate``: incomplete, rejected or good.  ``rejected`` names a column that
    keeps the raw text of the rejected rows (a struct, NULL for the others), from which ``rejected_of`` makes
    ``rejected_static`` without reading the seed again."""
    both = raw.select("*", *_typed_columns(_P))
    bad = any_of(F.coalesce(cond, F.lit(False)) for cond, _ in parse_rules(_P))
    fate = F.when(~complete_case(S.SALES_CSV_COLUMNS), "incomplete").when(bad, "rejected").otherwise("good")
    kept = []
    if rejected:
        from ledgerline.plans.imports import CSV_TO_STATIC
        text = F.struct(*[_q(src).alias(dst) for src, dst in CSV_TO_STATIC.items()])
        kept = [F.when(fate == "rejected", text).alias(rejected)]
    return both.select(*[F.col(_P + c).alias(c) for c in STATIC_COLUMNS], fate.alias("fate"), *kept)


def rejected_of(fates: DataFrame, rejected: str) -> DataFrame:
    """``rejected_static`` from the rows of ``with_fates``."""
    return (fates.where("fate = 'rejected'").withColumn("error_message", messages(*parse_rules()))
            .select(*[F.col(rejected)[c].alias(c) for c in S.TRANSACTIONS_STATIC.fieldNames()], "error_message"))


def static_accounting(raw: DataFrame) -> DataFrame:
    """Rows of the seed by fate: incomplete, rejected, good; they add up to the input."""
    return with_fates(raw).groupBy("fate").agg(F.count(F.lit(1)).alias("row_count"))
