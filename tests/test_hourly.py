import datetime as dt

from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.plans import marts, staging
from ledgerline.plans.hourly import run_hourly

T0 = dt.datetime(2024, 1, 1)


def _oltp(spark, upto_day: int):
    items = spark.createDataFrame([(1, "Mocha", "", 3.75, T0, T0), (2, "Chai", "", 2.25, T0, T0)],
                                  S.ITEMS)
    customers = spark.createDataFrame([(1, "a", "a@x.com", T0, T0)], S.CUSTOMERS)
    pms = spark.createDataFrame([(1, "Cash", True, T0), (2, "Credit Card", True, T0)],
                                S.PAYMENT_METHODS)
    tx = spark.createDataFrame(
        [(f"t{d}", 1, 1 + d % 2, "In-store", float(d), "completed",
          dt.datetime(2024, 3, d), dt.datetime(2024, 3, d)) for d in range(1, upto_day + 1)],
        S.TRANSACTIONS)
    ti = spark.createDataFrame(
        [(f"t{d}", 1 + d % 2, 1, 3.75, 3.75, dt.datetime(2024, 3, d)) for d in range(1, upto_day + 1)],
        S.TRANSACTION_ITEMS)
    return {"items": items, "customers": customers, "payment_methods": pms,
            "transactions": tx, "transaction_items": ti}


def _seed(spark):
    return spark.createDataFrame(
        [("TXN_1", "Mocha", "2", "3.75", "7.0", "In-store", "Cash", "2024-01-05"),
         ("TXN_2", "Chai", "ERROR", "2.25", "2.25", "Takeaway", "Cash", "2024-01-06"),
         ("TXN_3", "Chai", "1", "2.25", "2.25", "Takeaway", "Credit Card", "2024-01-07")],
        S.SALES_CSV)


def _rows(spark, path):
    return sorted(spark.read.parquet(path).collect(), key=repr)


def test_two_runs_equal_full_build_and_rerun_is_noop(spark, tmp_root):
    seed = _seed(spark)
    run_hourly(spark, _oltp(spark, 3), seed, tmp_root, exclude_tags=())
    rep = run_hourly(spark, _oltp(spark, 6), seed, tmp_root, exclude_tags=("static",))
    assert "stg_transactions_static" not in rep.models
    assert rep.loaded["transactions"] == 3          # only the new rows were appended

    full = _oltp(spark, 6)
    stg_static = staging.stg_transactions_static(seed)
    want = marts.fct_transactions(staging.stg_transactions(full["transactions"]), stg_static,
                                  staging.stg_payment_methods(full["payment_methods"]))
    fct = f"{tmp_root}/models/fct_transactions"
    assert _rows(spark, fct) == sorted(want.select(*spark.read.parquet(fct).columns).collect(),
                                       key=repr)

    before = _rows(spark, fct)
    rep = run_hourly(spark, _oltp(spark, 6), seed, tmp_root, exclude_tags=("static",))
    assert sum(rep.loaded.values()) == 0
    assert _rows(spark, fct) == before
    raw = spark.read.parquet(f"{tmp_root}/raw/transactions")
    assert raw.count() == 6 and raw.select("transaction_id").distinct().count() == 6
    ti = spark.read.parquet(f"{tmp_root}/models/dim_transaction_items")
    assert ti.where(F.col("transaction_id").startswith("TXN_")).count() == 2
