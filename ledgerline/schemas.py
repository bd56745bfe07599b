"""Explicit schemas of the shop data model.  No schema is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

TS = T.TimestampNTZType()  # wall-clock timestamps, as the driver's Parquet stores them


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ITEMS = _s(("item_id", T.LongType()), ("name", T.StringType()), ("description", T.StringType()),
           ("unit_price", T.DoubleType()), ("created_at", TS), ("updated_at", TS))

CUSTOMERS = _s(("customer_id", T.LongType()), ("name", T.StringType()), ("email", T.StringType()),
               ("created_at", TS), ("updated_at", TS))

PAYMENT_METHODS = _s(("payment_method_id", T.LongType()), ("name", T.StringType()),
                     ("is_active", T.BooleanType()), ("created_at", TS))

TRANSACTIONS = _s(("transaction_id", T.StringType()), ("customer_id", T.LongType()),
                  ("payment_method_id", T.LongType()), ("location", T.StringType()),
                  ("total_spent", T.DoubleType()), ("status", T.StringType()),
                  ("created_at", TS), ("updated_at", TS))

TRANSACTION_ITEMS = _s(("transaction_id", T.StringType()), ("item_id", T.LongType()),
                       ("quantity", T.LongType()), ("unit_price", T.DoubleType()),
                       ("subtotal", T.DoubleType()), ("created_at", TS))

# Raw historical sales as imported from the CSV: every field kept as text.
TRANSACTIONS_STATIC = _s(*[(n, T.StringType()) for n in (
    "transaction_id", "item", "quantity", "price_per_unit", "total_spent",
    "payment_method", "location", "transaction_date")])

TRANSACTIONS_ERRORS = _s(("id", T.LongType()),
                         *[(f.name, T.StringType()) for f in TRANSACTIONS_STATIC.fields],
                         ("error_message", T.StringType()), ("created_at", TS))

# Header of the dirty sales CSV (names with spaces), all columns as strings.
SALES_CSV_COLUMNS = ["Transaction ID", "Item", "Quantity", "Price Per Unit", "Total Spent",
                     "Location", "Payment Method", "Transaction Date"]
SALES_CSV = _s(*[(n, T.StringType()) for n in SALES_CSV_COLUMNS])

# A sale request: one transaction with a list of items.
REQUEST_ITEM = _s(("item_name", T.StringType()), ("quantity", T.LongType()))
TRANSACTION_REQUEST = _s(("customer_email", T.StringType()),
                         ("items", T.ArrayType(REQUEST_ITEM)),
                         ("payment_method", T.StringType()), ("location", T.StringType()),
                         ("created_at", TS), ("updated_at", TS))

# Modelled outputs.
STG_TRANSACTIONS_STATIC = _s(("transaction_id", T.StringType()), ("item_name", T.StringType()),
                             ("quantity", T.LongType()), ("unit_price", T.DoubleType()),
                             ("total_spent", T.DoubleType()), ("location", T.StringType()),
                             ("payment_method", T.StringType()), ("transaction_date", T.DateType()))

DIM_TRANSACTION_ITEMS = TRANSACTION_ITEMS

FCT_TRANSACTIONS = _s(("transaction_id", T.StringType()), ("customer_id", T.LongType()),
                      ("payment_method_name", T.StringType()), ("location", T.StringType()),
                      ("total_spent", T.DoubleType()), ("created_at", TS), ("updated_at", TS),
                      ("transaction_date", T.DateType()))

OLTP_TABLES = {
    "items": ITEMS,
    "customers": CUSTOMERS,
    "payment_methods": PAYMENT_METHODS,
    "transactions": TRANSACTIONS,
    "transaction_items": TRANSACTION_ITEMS,
    "transactions_static": TRANSACTIONS_STATIC,
    "transactions_errors": TRANSACTIONS_ERRORS,
}
