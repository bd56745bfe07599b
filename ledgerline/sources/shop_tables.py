"""The shop's OLTP tables, derived from the driver's TPC-H-style test tables.

Every table here is a projection (or a small aggregate) of a given table, so its size
grows with the data.  The same mapping is written in DuckDB SQL in
``ledgerline.oracle`` and both sides must stay equal, column for column.

mapping (fixed values that define the test data model):
    items            <- part      (item_id=p_partkey, name=p_name and p_partkey div 4, so that
                                   at most four parts share a name, description=p_type,
                                   unit_price=p_retailprice, created_at=2024-01-01,
                                   updated_at=2024-01-01 + p_size days)
    customers        <- customer  (email = lower(c_name with '#' -> '.') || '@example.com')
    payment_methods  <- distinct o_orderpriority ('1-URGENT' -> id 1, name 'URGENT')
    transactions     <- orders    (even key In-store, odd Takeaway; F/O/other status
                                   -> completed/pending/cancelled; times = o_orderdate)
    transaction_items<- lineitem  (unit_price = l_extendedprice / l_quantity)
    sales_dirty      <- events joined to part on p_partkey = event_id mod count(part),
                        with sentinels ERROR / UNKNOWN / NULL placed by event_id residues
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S

BASE_DATE = "2024-01-01"  # fixed value: creation date of the reference rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _base_ts(days: F.Column | None = None) -> F.Column:
    d = F.lit(BASE_DATE).cast("date")
    if days is not None:
        d = F.date_add(d, days.cast("int"))
    return d.cast("timestamp_ntz")


def _item_name() -> F.Column:
    return F.concat("p_name", F.lit(" "), F.expr("p_partkey div 4").cast("string"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("bigint").alias("item_id"),
        _item_name().alias("name"),
        F.col("p_type").alias("description"),
        F.col("p_retailprice").cast("double").alias("unit_price"),
        _base_ts().alias("created_at"),
        _base_ts(F.col("p_size")).alias("updated_at"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("bigint").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                 F.lit("@example.com")).alias("email"),
        _base_ts().alias("created_at"),
        _base_ts(F.col("c_nationkey")).alias("updated_at"),
    )


def _pm_id(col: str = "o_orderpriority") -> F.Column:
    return F.split(F.col(col), "-", 2).getItem(0).cast("bigint")


def _pm_name(col: str = "o_orderpriority") -> F.Column:
    return F.split(F.col(col), "-", 2).getItem(1)


def payment_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A distinct over orders: partial aggregation leaves at most a handful of rows per
    # task, so the shuffle is tiny however large orders is.
    o = table(spark, sf_dir, "orders")
    return o.select(
        _pm_id().alias("payment_method_id"),
        _pm_name().alias("name"),
        F.lit(True).alias("is_active"),
        _base_ts().alias("created_at"),
    ).distinct()


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        _pm_id().alias("payment_method_id"),
        F.when(F.col("o_orderkey") % 2 == 0, "In-store").otherwise("Takeaway").alias("location"),
        F.col("o_totalprice").cast("double").alias("total_spent"),
        F.when(F.col("o_orderstatus") == "F", "completed")
         .when(F.col("o_orderstatus") == "O", "pending")
         .otherwise("cancelled").alias("status"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("updated_at"),
    )


def transaction_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.col("l_partkey").cast("bigint").alias("item_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("subtotal"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("created_at"),
    )


def sales_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty historical sales file, as CSV text columns with spaces in their names.

    Sentinels are placed by residues of event_id (fixed values: 97 null id; 11/13/17
    item ERROR/UNKNOWN/null; 19/23 quantity; 29 price; 31 total; 37 location null;
    41 payment ERROR; 43 date UNKNOWN; payment by user_id mod 3).  Values that don't parse: 47
    quantity, 53 total, 61 date.  59 gives an item with quotes, a comma and a line feed.
    """
    ev = table(spark, sf_dir, "events")
    part = table(spark, sf_dir, "part")
    n_parts = part.select(F.count(F.lit(1))).scalar()  # scalar subquery, no driver round trip
    e = ev.withColumn("_pk", F.col("event_id") % n_parts)
    # a left join: every event stays a sale even if the part keys had gaps
    j = e.join(part, e["_pk"] == part["p_partkey"], "left")
    eid, uid = F.col("event_id"), F.col("user_id")
    s = lambda v: F.lit(v)
    return j.select(
        F.when(eid % 97 == 0, s(None).cast("string"))
         .otherwise(F.concat(s("TXN_"), eid.cast("string"))).alias("Transaction ID"),
        F.when(eid % 11 == 0, s("ERROR")).when(eid % 13 == 0, s("UNKNOWN"))
         .when(eid % 17 == 0, s(None).cast("string"))
         .when(eid % 59 == 0, s('a "hot" tea,\nbig')).otherwise(_item_name()).alias("Item"),
        F.when(eid % 19 == 0, s("ERROR")).when(eid % 23 == 0, s("UNKNOWN")).when(eid % 47 == 0, s("two"))
         .otherwise((eid % 5 + 1).cast("string")).alias("Quantity"),
        F.when(eid % 29 == 0, s("ERROR"))
         .otherwise(F.col("p_retailprice").cast("string")).alias("Price Per Unit"),
        F.when(eid % 31 == 0, s("UNKNOWN")).when(eid % 53 == 0, s("n/a"))
         .otherwise(F.col("value").cast("string")).alias("Total Spent"),
        F.when(eid % 37 == 0, s(None).cast("string")).when(eid % 2 == 0, s("In-store"))
         .otherwise(s("Takeaway")).alias("Location"),
        F.when(eid % 41 == 0, s("ERROR")).when(uid % 3 == 0, s("Cash"))
         .when(uid % 3 == 1, s("Credit Card")).otherwise(s("Digital Wallet")).alias("Payment Method"),
        F.when(eid % 43 == 0, s("UNKNOWN")).when(eid % 61 == 0, s("2024-13-45"))
         .otherwise(F.col("ts").cast("date").cast("string")).alias("Transaction Date"),
    )


def transactions_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw static table as the import stores it: snake_case text columns."""
    d = sales_dirty(spark, sf_dir)
    return d.select(*[F.col(f"`{src}`").alias(dst) for src, dst in zip(
        S.SALES_CSV_COLUMNS,
        ["transaction_id", "item", "quantity", "price_per_unit", "total_spent",
         "location", "payment_method", "transaction_date"])])


def request_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale requests, one row per order (flat form of the nested request body).

    Dirt placed by o_orderkey residues (fixed values): 101 blank email; 89 a new
    customer's email; 10 -> 3 padded upper-case email; 53 unknown payment 'Bitcoin';
    59 bad location 'Delivery'.
    """
    o = table(spark, sf_dir, "orders")
    c = customers(spark, sf_dir).select(F.col("customer_id").alias("__cid"), "email")
    j = o.join(c, o["o_custkey"] == c["__cid"], "left")
    k = F.col("o_orderkey")
    return j.select(
        k.cast("string").alias("request_id"),
        F.when(k % 101 == 0, F.lit("   "))
         .when(k % 89 == 0, F.concat(F.lit("new."), F.col("o_custkey").cast("string"),
                                     F.lit("@shop.example")))
         .when(k % 10 == 3, F.concat(F.lit("  "), F.upper("email"), F.lit(" ")))
         .otherwise(F.col("email")).alias("customer_email"),
        F.when(k % 53 == 0, F.lit("Bitcoin")).otherwise(_pm_name()).alias("payment_method"),
        F.when(k % 59 == 0, F.lit("Delivery")).when(k % 2 == 0, F.lit("In-store"))
         .otherwise(F.lit("Takeaway")).alias("location"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("updated_at"),
    )


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item lines of the sale requests, one row per lineitem, item named by its part.

    Dirt by l_orderkey residues on line 1 (fixed values): 67 unknown item; 71 blank
    name; 61 quantity 0; 7 -> 1 name padded with spaces (any line).
    """
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", _item_name().alias("p_name"))
    j = li.join(p, li["l_partkey"] == p["p_partkey"], "left")
    k, first = F.col("l_orderkey"), F.col("l_linenumber") == 1
    return j.select(
        k.cast("string").alias("request_id"),
        F.col("l_linenumber").cast("int").alias("line_no"),
        F.when((k % 67 == 0) & first, F.lit("Unknown Gadget"))
         .when((k % 71 == 0) & first, F.lit("  "))
         .when(k % 7 == 1, F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")))
         .otherwise(F.col("p_name")).alias("item_name"),
        F.when((k % 61 == 0) & first, F.lit(0).cast("bigint"))
         .otherwise(F.col("l_quantity").cast("bigint")).alias("quantity"),
    )


OLTP = {
    "items": items,
    "customers": customers,
    "payment_methods": payment_methods,
    "transactions": transactions,
    "transaction_items": transaction_items,
}
