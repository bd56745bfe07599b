"""Every query the repo offers, keyed by name: ``(spark, sf_dir) -> DataFrame``.

Each reads the driver's tables at ``sf_dir`` (through ``ShopModels``), so its work grows
with them.  ``ledgerline.oracle`` holds the DuckDB SQL for the same keys.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators.latest import latest_by
from ledgerline.operators.quality import drop_sentinels
from ledgerline.plans import analytics as an
from ledgerline.plans.models import ShopModels
from ledgerline.sources import shop_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _m(spark: SparkSession, sf_dir: str) -> ShopModels:
    return ShopModels.from_testdata(spark, sf_dir)


def lookup_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of requested transaction ids, one per event (about a quarter miss)."""
    ev = shop_tables.table(spark, sf_dir, "events")
    return ev.select((F.col("event_id") * 2).cast("string").alias("transaction_id")).distinct()


# --- analytics ---------------------------------------------------------------------------

@query("monthly_sales")
def q_monthly_sales(spark, sf_dir):
    return an.monthly_sales(_m(spark, sf_dir).fct_transactions)


@query("item_quantity")
def q_item_quantity(spark, sf_dir):
    return _m(spark, sf_dir).item_quantity


@query("item_share")
def q_item_share(spark, sf_dir):
    return an.with_share(_m(spark, sf_dir).item_quantity)


@query("item_quantity_table")
def q_item_quantity_table(spark, sf_dir):
    """The dashboard query as written: over the built transaction-items model."""
    m = _m(spark, sf_dir)
    return an.item_quantity(m.dim_transaction_items, m.dim_items)


@query("explore_scan")
def q_explore(spark, sf_dir):
    return an.explore(_m(spark, sf_dir).fct_transactions)


@query("count_transactions")
def q_count(spark, sf_dir):
    return an.count_transactions(shop_tables.transactions(spark, sf_dir))


@query("list_transactions")
def q_list(spark, sf_dir):
    return an.list_transactions(shop_tables.transactions(spark, sf_dir))


@query("get_transaction")
def q_get(spark, sf_dir):
    found, _ = an.get_transactions(shop_tables.transactions(spark, sf_dir),
                                   lookup_ids(spark, sf_dir))
    return found


@query("get_transaction_missing")
def q_get_missing(spark, sf_dir):
    _, missing = an.get_transactions(shop_tables.transactions(spark, sf_dir),
                                     lookup_ids(spark, sf_dir))
    return missing


@query("table_counts")
def q_table_counts(spark, sf_dir):
    t = shop_tables
    return an.table_counts({
        "transaction_items": t.transaction_items(spark, sf_dir),
        "transactions": t.transactions(spark, sf_dir),
        "transactions_static": t.sales_dirty(spark, sf_dir),
        "customers": t.customers(spark, sf_dir),
        "items": t.items(spark, sf_dir),
        "payment_methods": t.payment_methods(spark, sf_dir),
    })


# --- staging -------------------------------------------------------------------------------

for _name in ["stg_customers", "stg_items", "stg_payment_methods", "stg_transactions",
              "stg_transaction_items", "stg_transactions_static",
              "dim_customers", "dim_items", "dim_payment_methods",
              "dim_transaction_items", "fct_transactions"]:
    QUERIES[_name] = (lambda attr: (lambda spark, sf_dir: getattr(_m(spark, sf_dir), attr)))(_name)


@query("drop_sentinels")
def q_drop_sentinels(spark, sf_dir):
    return drop_sentinels(shop_tables.sales_dirty(spark, sf_dir))


@query("latest_by")
def q_latest_by(spark, sf_dir):
    return latest_by(_m(spark, sf_dir).stg_items, ["name"], ["updated_at", "item_id"])


# --- incremental (F2, F3, A4, I1, I5, I6, S7) ------------------------------------------------
# Scenario constants (fixed values of the test scenarios, not row caps): a previous run
# that stopped at a date, and an increment that overlaps it.
STATIC_CUT = "2024-01-15"      # static table already loaded up to this date
FACT_CUT = "1998-06-30"        # fact already loaded up to this date
CURSOR_AT = "1998-06-01"       # cursor load stopped on this timestamp, half the rows loaded
MERGE_FIRST_END = "1998-01-01"  # first fact build: dates before this
MERGE_SRC_START = "1997-12-01"  # the increment begins here
MOVE_DAYS = 40
ITEMS_CUT = "2024-01-20"       # items known to the first of two incremental runs


def _d(s: str):
    return F.lit(s).cast("date")


@query("newer_than_strict")
def q_newer_strict(spark, sf_dir):
    from ledgerline.operators.incremental import high_water
    from ledgerline.plans.staging import clean_static
    m = _m(spark, sf_dir)
    target = m.stg_transactions_static.where(F.col("transaction_date") <= _d(STATIC_CUT))
    good, _ = clean_static(m.source("sales_dirty"), high_water(target, "transaction_date"))
    return good.distinct()


@query("newer_than_inclusive")
def q_newer_inclusive(spark, sf_dir):
    """The mark is read as a value first, so the filter on the new rows is a literal
    range that reaches the Parquet scan."""
    from ledgerline.operators.incremental import high_water_value
    from ledgerline.plans.marts import live_facts
    m = _m(spark, sf_dir)
    target = m.fct_transactions.where(F.col("transaction_date") <= _d(FACT_CUT))
    return live_facts(m.stg_transactions, m.dim_payment_methods,
                      high_water_value(target, "transaction_date"))


@query("high_water")
def q_high_water(spark, sf_dir):
    return _m(spark, sf_dir).fct_transactions.agg(F.max("transaction_date").alias("high_water"))


def _cursor_target(tx: DataFrame) -> DataFrame:
    at = F.lit(CURSOR_AT).cast("timestamp_ntz")
    return tx.where((F.col("updated_at") < at) |
                    ((F.col("updated_at") == at) & (F.col("location") == "In-store")))


@query("incremental_load")
def q_incremental_load(spark, sf_dir):
    from ledgerline.operators.incremental import incremental_load
    tx = shop_tables.transactions(spark, sf_dir)
    return incremental_load(tx, _cursor_target(tx), "updated_at", ["transaction_id"])


def _by_month(df: DataFrame) -> DataFrame:
    return df.withColumn("sale_month", F.trunc("transaction_date", "MM"))


def _merge_inputs(m: ShopModels, shift_days: int | None):
    """The fact before a date, and an increment from a month earlier to the end, static sales
    (no customer, no times, later dates) among it."""
    fct = m.fct_transactions
    first = fct.where(F.col("transaction_date") < _d(MERGE_FIRST_END))
    src = fct.where(F.col("transaction_date") >= _d(MERGE_SRC_START))
    if shift_days is None:
        src = src.withColumn("total_spent", F.col("total_spent") + F.lit(1.0))
    else:
        src = src.withColumn("transaction_date", F.date_add("transaction_date", shift_days))
    return _by_month(first), _by_month(src)


def _run_merge(spark, sf_dir, shift_days):
    from ledgerline.operators.merge import merge_upsert
    from ledgerline.session import scratch_path
    m = _m(spark, sf_dir)
    first, src = _merge_inputs(m, shift_days)
    path = scratch_path(spark, "merge")
    merge_upsert(spark, path, first, "transaction_id", "sale_month")
    merge_upsert(spark, path, src, "transaction_id", "sale_month")
    return spark.read.parquet(path).drop("sale_month")


@query("merge_upsert")
def q_merge_upsert(spark, sf_dir):
    return _run_merge(spark, sf_dir, None)


@query("merge_moved_partition")
def q_merge_moved(spark, sf_dir):
    return _run_merge(spark, sf_dir, MOVE_DAYS)


@query("cursor_state")
def q_cursor_state(spark, sf_dir):
    """The saved cursor of each raw table: max of its cursor column."""
    from ledgerline.operators.incremental import cursor_state
    from ledgerline.functions.scalar import to_date_safe
    from ledgerline.plans.hourly import CURSORS, DATE_CURSORS
    tables = {t: fn(spark, sf_dir) for t, fn in shop_tables.OLTP.items()}
    tables["transactions_static"] = shop_tables.transactions_static(spark, sf_dir)
    return cursor_state({t: (df.withColumn(CURSORS[t][0], to_date_safe(CURSORS[t][0]))
                             if t in DATE_CURSORS else df, CURSORS[t][0])
                         for t, df in tables.items()})


def _keyed(spark, sf_dir) -> DataFrame:
    """Transactions with a key that some rows lack and a text partition column whose values
    need escaping in folder names."""
    tx = shop_tables.transactions(spark, sf_dir)
    return tx.select(
        F.when(F.col("transaction_id").cast("bigint") % 13 != 0, F.col("transaction_id")).alias("k"),
        "location", "total_spent", F.date_format("created_at", "yyyy:MM").alias("month"))


@query("merge_null_keys")
def q_merge_null_keys(spark, sf_dir):
    """A year merged in again as it is: rows without a key match nothing, so they are added."""
    from ledgerline.operators.merge import merge_upsert
    from ledgerline.session import scratch_path
    df = _keyed(spark, sf_dir)
    path = scratch_path(spark, "merge_null")
    merge_upsert(spark, path, df, "k", "month")
    merge_upsert(spark, path, df.where(F.col("month").startswith("1997:")), "k", "month")
    return spark.read.parquet(path)


@query("merge_text_partition")
def q_merge_text_partition(spark, sf_dir):
    """All rows of a year move to one partition: the folders that they leave must go."""
    from ledgerline.operators.merge import merge_upsert
    from ledgerline.session import scratch_path
    df = _keyed(spark, sf_dir).where(F.col("k").isNotNull())
    path = scratch_path(spark, "merge_text")
    merge_upsert(spark, path, df, "k", "month")
    merge_upsert(spark, path, df.where(F.col("month").startswith("1997:"))
                 .withColumn("month", F.lit("moved: a/b=c")), "k", "month")
    return spark.read.parquet(path)


@query("replace_partitioned")
def q_replace_partitioned(spark, sf_dir):
    """A replace drops the partitions that the new rows don't have."""
    from ledgerline.session import scratch_path
    from ledgerline.sinks.load import load
    df = _keyed(spark, sf_dir)
    path = scratch_path(spark, "replace")
    load(df, path, "replace", ["month"])
    load(df.where(F.col("month") >= "1997:12"), path, "replace", ["month"])
    return spark.read.parquet(path)


@query("full_refresh")
def q_full_refresh(spark, sf_dir):
    """The static model as an incremental table, then built anew from fewer rows."""
    from ledgerline.session import scratch_path
    from ledgerline.sinks.load import materialize
    stg = _m(spark, sf_dir).stg_transactions_static
    path = scratch_path(spark, "refresh")
    options = {"kind": "incremental", "partition_by": ["transaction_date"], "path": path,
               "unique_key": "transaction_id"}
    materialize(stg, "static_incremental", **options)
    return materialize(stg.where(F.col("transaction_date") > _d(STATIC_CUT)), "static_incremental",
                       full_refresh=True, **options)


@query("cursor_quarantine")
def q_cursor_quarantine(spark, sf_dir):
    """Two loads of snapshots in which some cursors are missing or no dates: what could not be
    placed, once."""
    from ledgerline.plans.hourly import Warehouse, extract, load_raw
    from ledgerline.session import scratch_path
    wh = Warehouse(scratch_path(spark, "cursors"))
    tables = {"transactions": _null_cursors(shop_tables.transactions(spark, sf_dir)),
              "transactions_static": shop_tables.transactions_static(spark, sf_dir)}
    extract(tables, wh)
    for _ in range(2):
        load_raw(spark, wh, list(tables))
    return spark.read.parquet(wh.quarantine("load")).select("table_name", "row_key", "error_message")


def _null_cursors(tx: DataFrame) -> DataFrame:
    return tx.withColumn("updated_at", F.when(F.col("transaction_id").cast("bigint") % 23 != 0,
                                              F.col("updated_at")))


@query("fanout_hot_key")
def q_fanout_hot_key(spark, sf_dir):
    """One item id with all versions, a few names: the hot names split into buckets of ten rows, in which equal
    copies are counted, so a sale meets one row for them and not each."""
    from ledgerline.plans.marts import static_items
    m = _m(spark, sf_dir)
    word = F.split("name", " ").getItem(0)
    items = m.stg_items.withColumn("item_id", F.lit(7).cast("bigint")).withColumn("name", word)
    sales = m.stg_transactions_static.withColumn("item_name", F.split("item_name", " ").getItem(0))
    out = static_items(sales, items, rows_per_task=10, copies="copies")
    return out.groupBy("transaction_id", "item_id").agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n"), F.sum(F.col("quantity") * F.col("copies")).alias("quantity"))


@query("append_replace_load")
def q_append_replace(spark, sf_dir):
    from ledgerline.session import scratch_path
    from ledgerline.sinks.load import load
    tx = shop_tables.transactions(spark, sf_dir)
    path = scratch_path(spark, "raw_transactions")
    load(tx.where(F.col("created_at") < F.lit(MERGE_FIRST_END).cast("timestamp_ntz")), path,
         "replace")
    load(tx.where(F.col("created_at") >= F.lit(MERGE_SRC_START).cast("timestamp_ntz")), path,
         "append")
    return spark.read.parquet(path)


@query("schema_guard")
def q_schema_guard(spark, sf_dir):
    """The fact increment, let through only after its schema is checked against the
    target's (the target schema is the fact's; a changed one raises SchemaChanged)."""
    from ledgerline.operators.incremental import assert_same_schema, high_water
    from ledgerline.plans.marts import fct_transactions
    m = _m(spark, sf_dir)
    target = m.fct_transactions.where(F.col("transaction_date") <= _d(FACT_CUT))
    new = fct_transactions(m.stg_transactions, m.stg_transactions_static,
                           m.dim_payment_methods, high_water(target, "transaction_date"))
    assert_same_schema(new, target)
    return new


# --- quality (R11, R12, R13, R14) -------------------------------------------------------------

@query("check_unique")
def q_check_unique(spark, sf_dir):
    from ledgerline.operators.quality import check_unique
    return check_unique(shop_tables.transaction_items(spark, sf_dir),
                        ["transaction_id", "item_id"])


@query("check_fk")
def q_check_fk(spark, sf_dir):
    """Transactions whose customer is gone: the parent table keeps only customers with a
    non-negative balance (a deletion upstream, which the append load never carries)."""
    from ledgerline.operators.quality import check_fk
    parents = shop_tables.table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0) \
        .select(F.col("c_custkey").alias("customer_id"))
    return check_fk(shop_tables.transactions(spark, sf_dir), parents, ["customer_id"])


@query("check_subtotal")
def q_check_subtotal(spark, sf_dir):
    from ledgerline.operators.quality import check_subtotal
    return check_subtotal(shop_tables.transaction_items(spark, sf_dir))


@query("integrity_report")
def q_integrity_report(spark, sf_dir):
    """All unique keys and references of the shop's tables; customers with a negative balance
    are gone, as in check_fk."""
    from ledgerline.operators.quality import integrity_report
    t = shop_tables
    tx, ti = t.transactions(spark, sf_dir), t.transaction_items(spark, sf_dir)
    items, pm = t.items(spark, sf_dir), t.payment_methods(spark, sf_dir)
    gone = t.table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0).select("c_custkey")
    customers = t.customers(spark, sf_dir).join(gone, F.col("customer_id") == F.col("c_custkey"), "left_anti")
    return integrity_report(
        [("transactions_static.transaction_id", t.transactions_static(spark, sf_dir), ["transaction_id"]),
         ("items.item_id", items, ["item_id"]), ("customers.customer_id", customers, ["customer_id"]),
         ("customers.email", customers, ["email"]), ("payment_methods.payment_method_id", pm, ["payment_method_id"]),
         ("payment_methods.name", pm, ["name"]), ("transactions.transaction_id", tx, ["transaction_id"]),
         ("transaction_items.transaction_id, item_id", ti, ["transaction_id", "item_id"])],
        [("transactions.customer_id", tx, "customer_id", customers, "customer_id"),
         ("transactions.payment_method_id", tx, "payment_method_id", pm, "payment_method_id"),
         ("transaction_items.transaction_id", ti, "transaction_id", tx, "transaction_id"),
         ("transaction_items.item_id", ti, "item_id", items, "item_id")])


@query("static_quarantine")
def q_static_quarantine(spark, sf_dir):
    from ledgerline.plans.staging import rejected_static
    return rejected_static(shop_tables.sales_dirty(spark, sf_dir))


@query("static_accounting")
def q_static_accounting(spark, sf_dir):
    """Good, rejected and incomplete rows of the seed; they add up to it."""
    from ledgerline.plans.staging import static_accounting
    return static_accounting(shop_tables.sales_dirty(spark, sf_dir))


@query("validate_static")
def q_validate_static(spark, sf_dir):
    from ledgerline.plans.imports import validate_static_rows
    _, rejected = validate_static_rows(shop_tables.transactions_static(spark, sf_dir))
    return rejected


# --- ingest (M13, J4, J5, J6) --------------------------------------------------------------------

def _ingest(spark, sf_dir):
    from ledgerline.plans.ingest import ingest_transactions
    t = shop_tables
    return ingest_transactions(t.request_headers(spark, sf_dir), t.request_lines(spark, sf_dir),
                               t.customers(spark, sf_dir), t.items(spark, sf_dir),
                               t.payment_methods(spark, sf_dir))


@query("validate_requests_good")
def q_validate_good(spark, sf_dir):
    return _ingest(spark, sf_dir).good_requests.select(
        "request_id", "email_norm", "payment_method_id", "n_lines")


@query("validate_requests_rejected")
def q_validate_rejected(spark, sf_dir):
    from ledgerline.plans.ingest import validate_requests
    t = shop_tables
    _, _, rejected = validate_requests(t.request_headers(spark, sf_dir),
                                       t.request_lines(spark, sf_dir), t.items(spark, sf_dir),
                                       t.payment_methods(spark, sf_dir))
    return rejected.select("request_id", "error_message")


@query("upsert_customers")
def q_upsert_customers(spark, sf_dir):
    return _ingest(spark, sf_dir).new_customers


@query("require_payment_method")
def q_require_pm(spark, sf_dir):
    from ledgerline.plans.ingest import lookup_payment
    t = shop_tables
    return lookup_payment(t.request_headers(spark, sf_dir), t.payment_methods(spark, sf_dir)) \
        .select("request_id", "payment_method", "payment_method_id")


@query("latest_price")
def q_latest_price(spark, sf_dir):
    from ledgerline.plans.ingest import latest_items
    return latest_items(shop_tables.items(spark, sf_dir)).select("name", "item_id", "unit_price")


@query("ingest_transactions")
def q_ingest_tx(spark, sf_dir):
    return _ingest(spark, sf_dir).transactions


@query("ingest_items")
def q_ingest_items(spark, sf_dir):
    return _ingest(spark, sf_dir).transaction_items


@query("ingest_nested")
def q_ingest_nested(spark, sf_dir):
    """The same requests as nested rows, their items in arrays, as a service receives them."""
    from ledgerline.plans.ingest import flatten_requests, ingest_transactions
    t = shop_tables
    lines = t.request_lines(spark, sf_dir).groupBy("request_id").agg(
        F.collect_list(F.struct("item_name", "quantity")).alias("items"))
    nested = t.request_headers(spark, sf_dir).join(lines, "request_id", "left")
    headers, flat = flatten_requests(nested)
    return ingest_transactions(headers, flat, t.customers(spark, sf_dir), t.items(spark, sf_dir),
                               t.payment_methods(spark, sf_dir)).transactions


@query("add_customers")
def q_add_customers(spark, sf_dir):
    """A batch of customers: a fifth known already, some twice in the batch, some blank."""
    from ledgerline.plans.ingest import add_customers
    have = shop_tables.customers(spark, sf_dir)
    k = F.col("customer_id")
    email = (F.when(k % 5 == 0, F.col("email")).when(k % 7 == 0, F.lit("twice@shop.example"))
             .when(k % 11 == 0, F.lit("\u00a0")).otherwise(F.concat(F.lit("n"), k.cast("string"), F.lit("@shop.example"))))
    new = have.select((k + 1_000_000_000).alias("customer_id"), "name", email.alias("email"), "created_at", "updated_at")
    good, bad = add_customers(new, have)
    return good.withColumn("error_message", F.lit(None).cast("string")).unionByName(bad)


@query("add_payment_methods")
def q_add_payment_methods(spark, sf_dir):
    """A batch of payment methods named after the parts' types, with repeats, and the known ones."""
    from ledgerline.plans.ingest import add_payment_methods
    have = shop_tables.payment_methods(spark, sf_dir)
    part = shop_tables.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    new = part.select((k + 100).cast("bigint").alias("payment_method_id"),
                      F.when(k % 4 == 0, F.col("p_type")).otherwise(F.concat("p_name", F.lit(" "), k.cast("string"))).alias("name"),
                      F.when(k % 3 == 0, F.lit(False)).alias("is_active"),
                      F.lit("2024-02-01").cast("timestamp_ntz").alias("created_at"))
    known = have.select((F.col("payment_method_id") + 50).alias("payment_method_id"), "name", "is_active", "created_at")
    good, bad = add_payment_methods(new.unionByName(known), have)
    return good.withColumn("error_message", F.lit(None).cast("string")).unionByName(bad)


@query("ingest_errors")
def q_ingest_errors(spark, sf_dir):
    return _ingest(spark, sf_dir).errors


# --- connectors (S2–S5, S13, S16, S17) -------------------------------------------------------

def _write_csv(spark, sf_dir) -> str:
    """The dirty sales file as CSV with a header (the seed the import reads), and files with
    malformed lines: one field too many, for one event in 101."""
    from ledgerline.session import scratch_path
    path = scratch_path(spark, "sales_csv")
    (shop_tables.sales_dirty(spark, sf_dir).write.option("header", True).option("escape", '"')
        .csv(f"{path}/set=whole"))
    header = ",".join(S.SALES_CSV_COLUMNS)
    bad = (shop_tables.table(spark, sf_dir, "events").where(F.col("event_id") % 101 == 0)
           .select((F.col("event_id") / 100_000).cast("bigint").alias("file"),
                   F.concat(F.lit("BAD_"), F.col("event_id").cast("string"),
                            F.lit(",tea,1,2.0,2.0,In-store,Cash,2024-01-01,extra")).alias("line")))
    (bad.groupBy("file").agg(F.concat(F.lit(header + "\n"), F.array_join(F.collect_list("line"), "\n")).alias("value"))
        .write.partitionBy("file").text(f"{path}/set=bad"))
    return path


def _import(spark, sf_dir, times: int, table: str = "transactions_static"):
    from ledgerline.plans.imports import import_static_csv
    from ledgerline.session import scratch_path
    csv = _write_csv(spark, sf_dir)
    root = scratch_path(spark, "oltp")
    for _ in range(times):
        import_static_csv(spark, [f"{csv}/set=whole", f"{csv}/set=bad/*"],
                          f"{root}/transactions_static", f"{root}/transactions_errors")
    return spark.read.parquet(f"{root}/{table}")


@query("import_errors")
def q_import_errors(spark, sf_dir):
    """The quarantine of the import: rows over the length limits and malformed lines."""
    out = _import(spark, sf_dir, 1, "transactions_errors")
    return out.select(*S.TRANSACTIONS_STATIC.fieldNames(), "error_message")


@query("import_error_ids")
def q_import_error_ids(spark, sf_dir):
    """Each quarantined row has an id of its own."""
    out = _import(spark, sf_dir, 1, "transactions_errors")
    return out.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("n_ids"))


@query("csv_import")
def q_csv_import(spark, sf_dir):
    return _import(spark, sf_dir, 1)


@query("load_if_empty")
def q_load_if_empty(spark, sf_dir):
    """Import twice: the second run finds rows and skips, so nothing doubles."""
    return _import(spark, sf_dir, 2)


@query("json_array_import")
def q_json_array(spark, sf_dir):
    """Items written as JSON documents with one root array each ({"items": [...]}, one
    document per thousand item ids, so a document's size is bounded), read back (S5)
    and checked as a batch of new items (M15)."""
    from ledgerline.plans.ingest import add_items
    from ledgerline.session import scratch_path
    from ledgerline.sources.files import read_json_array
    path = scratch_path(spark, "items_json")
    items = shop_tables.items(spark, sf_dir)
    docs = (items.groupBy((F.col("item_id") / 1000).cast("bigint").alias("doc"))
            .agg(F.to_json(F.struct(F.collect_list(F.struct(*items.columns)).alias("items")))
                 .alias("value")))
    docs.repartition("doc").write.partitionBy("doc").text(path)
    good, _ = add_items(read_json_array(spark, f"{path}/*/*.txt", "items", S.ITEMS))
    return good


@query("lake_snapshot")
def q_lake_snapshot(spark, sf_dir):
    """Snapshot transactions to the lake twice (the second replaces the first) and read
    the lake back by glob (S2, S3)."""
    from ledgerline.session import scratch_path
    from ledgerline.sinks.load import snapshot
    from ledgerline.sources.files import read_lake
    root = scratch_path(spark, "lake")
    tx = shop_tables.transactions(spark, sf_dir)
    snapshot(tx.where(F.col("created_at") < F.lit(MERGE_FIRST_END).cast("timestamp_ntz")),
             f"{root}/transactions")
    snapshot(tx, f"{root}/transactions")
    return read_lake(spark, root, "transactions", S.TRANSACTIONS)


@query("reset_tables")
def q_reset_tables(spark, sf_dir):
    """Write the seven OLTP tables, then empty them in dependency order; report the
    counts before and after (S13)."""
    from ledgerline.plans.imports import error_rows, validate_static_rows
    from ledgerline.session import scratch_path
    from ledgerline.sinks.reset import reset_tables
    t = shop_tables
    root = scratch_path(spark, "oltp")
    static = t.transactions_static(spark, sf_dir)
    good, rejected = validate_static_rows(static)
    tables = {
        "transaction_items": t.transaction_items(spark, sf_dir),
        "transactions": t.transactions(spark, sf_dir),
        "transactions_static": good,
        "transactions_errors": error_rows(rejected),
        "customers": t.customers(spark, sf_dir),
        "items": t.items(spark, sf_dir),
        "payment_methods": t.payment_methods(spark, sf_dir),
    }
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    return reset_tables(spark, root)


# --- whole hourly run (M16) and the streaming load (I8) ------------------------------------------

def _oltp_at(spark, sf_dir, cut: str | None) -> dict:
    t = shop_tables
    oltp = {name: fn(spark, sf_dir) for name, fn in t.OLTP.items()}
    oltp["transactions_static"] = t.transactions_static(spark, sf_dir)
    if cut is not None:
        ts = F.lit(cut).cast("timestamp_ntz")
        oltp["transactions"] = oltp["transactions"].where(F.col("updated_at") < ts)
        oltp["transaction_items"] = oltp["transaction_items"].where(F.col("created_at") < ts)
    return oltp


def hourly_two_runs(spark, sf_dir, exclude_static_second: bool):
    """First load (every step, OLTP as of MERGE_FIRST_END), then an hourly run on the full
    OLTP tables.  Returns the warehouse root and the second run's report."""
    from ledgerline.plans.hourly import run_hourly
    from ledgerline.session import scratch_path
    root = scratch_path(spark, "warehouse")
    seed = shop_tables.sales_dirty(spark, sf_dir)
    run_hourly(spark, _oltp_at(spark, sf_dir, MERGE_FIRST_END), seed, root, exclude_tags=(), by_month=True)
    report = run_hourly(spark, _oltp_at(spark, sf_dir, None), seed, root, by_month=True,
                        exclude_tags=("static",) if exclude_static_second else ())
    return root, report


@query("hourly_run")
def q_hourly_run(spark, sf_dir):
    root, _ = hourly_two_runs(spark, sf_dir, exclude_static_second=False)
    return spark.read.parquet(f"{root}/models/fct_transactions").drop("sale_month")


@query("hourly_rows_appended")
def q_hourly_rows_appended(spark, sf_dir):
    """Rows that the second run appended to each raw table."""
    from ledgerline.plans.hourly import loaded_rows
    _, report = hourly_two_runs(spark, sf_dir, exclude_static_second=True)
    return loaded_rows(spark, report)


@query("hourly_run_exclude_static")
def q_hourly_run_exclude_static(spark, sf_dir):
    root, _ = hourly_two_runs(spark, sf_dir, exclude_static_second=True)
    return spark.read.parquet(f"{root}/models/dim_transaction_items")


@query("load_report")
def q_load_report(spark, sf_dir):
    from ledgerline.plans.hourly import model_counts
    root, _ = hourly_two_runs(spark, sf_dir, exclude_static_second=False)
    return model_counts(spark, root, ["stg_transactions_static", "dim_customers", "dim_items",
                                      "dim_payment_methods", "dim_transaction_items",
                                      "fct_transactions"])


@query("stream_load")
def q_stream_load(spark, sf_dir):
    """Two hourly snapshots of transactions land in the lake folder (the second replaces
    the first and re-sends every row), in files by falling cursor, some rows without one; the
    stream loads them into the raw table one file at a time."""
    from ledgerline.session import scratch_path
    from ledgerline.sinks.load import snapshot
    from ledgerline.streaming.file_load import stream_load
    root = scratch_path(spark, "stream")
    cursor, keys = "updated_at", ["transaction_id"]
    tx = _null_cursors(shop_tables.transactions(spark, sf_dir))
    for cut in (MERGE_FIRST_END, None):
        snap = tx if cut is None else tx.where(
            F.col(cursor).isNull() | (F.col(cursor) < F.lit(cut).cast("timestamp_ntz")))
        snapshot(snap.repartitionByRange(4, F.col(cursor).desc_nulls_last()), f"{root}/lake/transactions")
        stream_load(spark, f"{root}/lake/transactions", f"{root}/raw/transactions",
                    f"{root}/checkpoint", S.TRANSACTIONS, cursor, keys, max_files_per_trigger=1)
    return spark.read.parquet(f"{root}/raw/transactions")


@query("stream_load_rejected")
def q_stream_load_rejected(spark, sf_dir):
    """What the stream could not place: the rows without a cursor, once."""
    from ledgerline.session import scratch_path
    from ledgerline.streaming.file_load import stream_load
    root = scratch_path(spark, "stream_rejected")
    tx = _null_cursors(shop_tables.transactions(spark, sf_dir))
    for _ in range(2):
        tx.write.mode("overwrite").parquet(f"{root}/lake")
        stream_load(spark, f"{root}/lake", f"{root}/raw", f"{root}/checkpoint", S.TRANSACTIONS,
                    "updated_at", ["transaction_id"], quarantine_path=f"{root}/rejected")
    return spark.read.parquet(f"{root}/rejected").select("row_key")


# --- versioned tables, stored cursors and the run kept up by deltas (S2, S12, I1, I2, I5, A7, M8-M11) --

class Killed(RuntimeError):
    """Stands for a job that dies."""


def _die() -> None:
    raise Killed("between the write and the commit")


@query("merge_crash_safe")
def q_merge_crash_safe(spark, sf_dir):
    """A merge that dies between its write and its commit, then the same merge again: what a reader sees after each.
    The first reader's DataFrame is read last, and still shows the version it was made from."""
    from ledgerline.operators.versioned_merge import merge_versioned
    from ledgerline.session import scratch_path
    from ledgerline.sinks.versioned import VersionedTable
    first, src = _merge_inputs(_m(spark, sf_dir), None)
    table = VersionedTable(spark, scratch_path(spark, "crash"), "sale_month")
    merge_versioned(table, first, "transaction_id")
    try:
        merge_versioned(table, src, "transaction_id", before_commit=_die)
    except Killed:
        pass
    crashed = table.read().withColumn("seen", F.lit("after the crash"))
    merge_versioned(table, src, "transaction_id")
    return crashed.unionByName(table.read().withColumn("seen", F.lit("after the merge"))).drop("sale_month")


@query("merge_versioned_moved")
def q_merge_versioned_moved(spark, sf_dir):
    """The merge in which keys move to other dates, partitioned by day, with the generations it left removed."""
    from ledgerline.operators.versioned_merge import merge_versioned
    from ledgerline.session import scratch_path
    from ledgerline.sinks.versioned import VersionedTable
    first, src = _merge_inputs(_m(spark, sf_dir), MOVE_DAYS)
    table = VersionedTable(spark, scratch_path(spark, "moved"), "transaction_date")
    for rows in (first, src):
        merge_versioned(table, rows.drop("sale_month"), "transaction_id")
    table.vacuum(keep=1, orphans=True)
    return table.read()


@query("state_resume")
def q_state_resume(spark, sf_dir):
    """A load by stored cursor, one that dies before its commit, and its repetition: every row once."""
    from ledgerline.operators.cursor_state import load_by_state
    from ledgerline.session import scratch_path
    from ledgerline.sinks.versioned import VersionedTable
    tx = shop_tables.transactions(spark, sf_dir)
    raw = VersionedTable(spark, scratch_path(spark, "resume"))
    load_by_state(raw, _cursor_target(tx), "updated_at", ["transaction_id"])
    try:
        load_by_state(raw, tx, "updated_at", ["transaction_id"], before_commit=_die)
    except Killed:
        pass
    load_by_state(raw, tx, "updated_at", ["transaction_id"])
    return raw.read()


@query("stored_cursors")
def q_stored_cursors(spark, sf_dir):
    """The cursors that two loads of every table leave: the mark and how many keys lie on it."""
    from ledgerline.operators.cursor_state import stored_cursors
    from ledgerline.plans import incremental_run as run
    from ledgerline.session import scratch_path
    store = run.Store(spark, scratch_path(spark, "stored"))
    for cut in (MERGE_FIRST_END, None):
        for name, df in _oltp_at(spark, sf_dir, cut).items():
            store.lake(name).replace(df)
            run.load(store, name)
    return stored_cursors(spark, {t: store.raw(t) for t in _oltp_at(spark, sf_dir, None)}).drop("version")


_TWO_RUNS: dict = {}


def incremental_two_runs(spark, sf_dir, by_month: bool = True):
    """A first run on the shop as of MERGE_FIRST_END, some items not yet known and sales up to STATIC_CUT, then
    a run on everything.  Returns the warehouse and the second run's report; the queries that look at one warehouse share
    it within an application."""
    from ledgerline.plans.incremental_run import Store, run_incremental
    from ledgerline.session import scratch_path
    key = (spark.sparkContext.applicationId, sf_dir, by_month)
    if key in _TWO_RUNS and _TWO_RUNS[key][0].ledger().exists():
        return _TWO_RUNS[key]
    store = Store(spark, scratch_path(spark, "incremental"), by_month)
    seed = shop_tables.sales_dirty(spark, sf_dir)
    early = _oltp_at(spark, sf_dir, MERGE_FIRST_END)
    early["items"] = early["items"].where(F.col("updated_at") < F.lit(ITEMS_CUT).cast("timestamp_ntz"))
    day = F.col("`Transaction Date`")
    run_incremental(spark, early, seed.where(day.isNull() | (day <= STATIC_CUT)), store.root, (), by_month)
    report = run_incremental(spark, _oltp_at(spark, sf_dir, None), seed, store.root, (), by_month)
    _TWO_RUNS[key] = store, report
    return store, report


@query("incremental_facts")
def q_incremental_facts(spark, sf_dir):
    """The fact by day after two runs."""
    store, _ = incremental_two_runs(spark, sf_dir, by_month=False)
    return store.facts()


@query("incremental_transaction_items")
def q_incremental_transaction_items(spark, sf_dir):
    """M8 by its delta; the second run brings lines, sales, and items that old sales were waiting for."""
    store, _ = incremental_two_runs(spark, sf_dir)
    return store.transaction_items()


@query("dashboard_monthly")
def q_dashboard_monthly(spark, sf_dir):
    """Monthly sales read from the roll-up of the second run."""
    store, _ = incremental_two_runs(spark, sf_dir)
    return store.monthly_sales()


@query("dashboard_item_quantity")
def q_dashboard_item_quantity(spark, sf_dir):
    """Quantity per item, read from the roll-up of the second run."""
    store, _ = incremental_two_runs(spark, sf_dir)
    return store.item_quantity()


@query("run_ledger")
def q_run_ledger(spark, sf_dir):
    """What the second run's steps that count single rows took and left."""
    from ledgerline.plans.incremental_run import LEDGER_COUNTS, run_ledger
    store, report = incremental_two_runs(spark, sf_dir)
    steps = F.col("step").startswith("extract_") | F.col("step").startswith("load_") | (F.col("step") == "stg_transactions_static")
    return run_ledger(store).where(steps & (F.col("run_id") == report.run_id)) \
        .select("step", "status", *LEDGER_COUNTS, "adds_up")


def _late_seed(spark, sf_dir):
    """A static model without the cash sales, then the whole seed: cash sales up to the mark come late."""
    from ledgerline.plans import incremental_run as run
    from ledgerline.session import scratch_path
    store = run.Store(spark, scratch_path(spark, "late"), by_month=True)
    seed = shop_tables.sales_dirty(spark, sf_dir)
    early = (F.col("`Transaction Date`") <= STATIC_CUT) & (F.col("`Payment Method`") != "Cash")
    run.static_model(store, seed.where(early))
    return store, seed


@query("late_static")
def q_late_static(spark, sf_dir):
    """The rows behind the mark that the second load of the static model sets aside."""
    from ledgerline.plans import incremental_run as run
    store, seed = _late_seed(spark, sf_dir)
    run.static_model(store, seed)
    return spark.read.parquet(store.quarantine("late_static")).select("table_name", "row_key", "error_message")


@query("static_fates")
def q_static_fates(spark, sf_dir):
    """Rows of the seed by what the second load does with them; they add up to the seed."""
    from ledgerline.plans.incremental_run import static_fates
    store, seed = _late_seed(spark, sf_dir)
    return static_fates(store, seed)


# --- catalog tables, reload after a reset, kept results, whole rejected requests (S6, S8, S13, S14, S19, X12, M13) --

def _database(spark, label: str) -> str:
    from ledgerline.session import scratch_path
    from ledgerline.sinks.catalog import create_database
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    create_database(spark, name, path)
    return name


def _seven_tables(spark, sf_dir) -> dict:
    from ledgerline.plans.imports import error_rows, validate_static_rows
    t = shop_tables
    good, rejected = validate_static_rows(t.transactions_static(spark, sf_dir))
    return {**{name: fn(spark, sf_dir) for name, fn in t.OLTP.items()},
            "transactions_static": good, "transactions_errors": error_rows(rejected)}


@query("catalog_monthly_sales")
def q_catalog_monthly_sales(spark, sf_dir):
    """The models over tables that are found by name, and the dashboard query over them."""
    from ledgerline.sinks.catalog import save_tables
    db = _database(spark, "shop")
    tables = {name: fn(spark, sf_dir) for name, fn in shop_tables.OLTP.items()}
    dirty = shop_tables.sales_dirty(spark, sf_dir)
    save_tables(spark, db, {**tables, "sales_dirty": dirty})
    models = ShopModels.from_catalog(spark, {n: f"{db}.{n}" for n in [*tables, "sales_dirty"]})
    return an.monthly_sales(models.fct_transactions)


@query("catalog_publish")
def q_catalog_publish(spark, sf_dir):
    """The fact published by name, merged with keys that move to other months, and published again."""
    from ledgerline.operators.versioned_merge import merge_versioned
    from ledgerline.session import scratch_path
    from ledgerline.sinks.catalog import publish
    from ledgerline.sinks.versioned import VersionedTable
    db = _database(spark, "published")
    first, src = _merge_inputs(_m(spark, sf_dir), MOVE_DAYS)
    table = VersionedTable(spark, scratch_path(spark, "fct"), "sale_month")
    for rows in (first, src):
        merge_versioned(table, rows, "transaction_id")
        publish(table, db, "fct_transactions")
    return spark.table(f"{db}.fct_transactions").drop("sale_month")


@query("catalog_truncate")
def q_catalog_truncate(spark, sf_dir):
    """The seven tables in a database, emptied children first."""
    from ledgerline.sinks.catalog import save_tables, truncate_tables
    from ledgerline.sinks.reset import RESET_ORDER
    db = _database(spark, "emptied")
    save_tables(spark, db, _seven_tables(spark, sf_dir))
    return truncate_tables(spark, db, RESET_ORDER)


@query("reset_and_reload")
def q_reset_and_reload(spark, sf_dir):
    """The seven tables written in one load, emptied, and some loaded again: rows before, and rows at the end."""
    from ledgerline.session import scratch_path
    from ledgerline.sinks.load import load_all
    from ledgerline.sinks.reset import RESET_ORDER, reset_and_reload
    root, tables = scratch_path(spark, "reload"), _seven_tables(spark, sf_dir)
    load_all(tables, root)
    again = {n: tables[n] for n in ("items", "customers", "payment_methods", "transactions")}
    before = reset_and_reload(spark, root, again).select("table_name", "rows_before")
    now = an.table_counts({n: spark.read.parquet(f"{root}/{n}") for n in RESET_ORDER})
    return before.join(now.withColumnRenamed("row_count", "rows_reloaded"), "table_name")


@query("kept_results")
def q_kept_results(spark, sf_dir):
    """Monthly sales out of the result cache, before and after a load: the second is not the kept one."""
    from ledgerline.session import scratch_path
    from ledgerline.sinks.cache import ResultCache
    from ledgerline.sinks.versioned import VersionedTable
    fct = _m(spark, sf_dir).fct_transactions
    table, cache, out = VersionedTable(spark, scratch_path(spark, "kept")), ResultCache(), []
    early = F.col("transaction_date") < _d(MERGE_FIRST_END)
    for rows in (fct.where(early), fct.where(~early)):
        table.append(rows)
        for _ in range(2):
            kept = cache.get("monthly", lambda: an.monthly_sales(table.read()), table.manifest().version)
        out.append(spark.createDataFrame(kept.collect(), kept.schema).withColumn("load", F.lit(len(out) + 1)))  # a row a month
    cache.clear()
    return out[0].unionByName(out[1])


@query("default_dates")
def q_default_dates(spark, sf_dir):
    """Raw static rows without a date get today's: how many rows there are, and how many hold today's text."""
    from ledgerline.functions.scalar import today_text
    from ledgerline.plans.ingest import with_defaults
    raw = shop_tables.transactions_static(spark, sf_dir)
    raw = raw.withColumn("transaction_date", F.when(F.col("transaction_date") != "UNKNOWN", F.col("transaction_date")))
    return with_defaults(raw).agg(F.count(F.lit(1)).alias("n"),
                                  F.count(F.when(F.col("transaction_date") == today_text(), 1)).alias("n_today"))


@query("ingest_error_items")
def q_ingest_error_items(spark, sf_dir):
    """The lines of the rejected requests as they came."""
    return _ingest(spark, sf_dir).error_items


@query("ingest_error_bodies")
def q_ingest_error_bodies(spark, sf_dir):
    """Each rejected request whole again, as the JSON that a service would send."""
    from ledgerline.plans.ingest import rebuild_requests
    res = _ingest(spark, sf_dir)
    return rebuild_requests(res.errors, res.error_items).select("transaction_id", "body")
