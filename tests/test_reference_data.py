import datetime as dt

from ledgerline import schemas as S
from ledgerline.plans.ingest import add_customers, add_items, add_payment_methods
from ledgerline.sinks.cache import ResultCache
from ledgerline.sinks.reset import reset_and_reload

TS = dt.datetime(2024, 1, 1, 8)


def test_add_customers_unique_email(spark):
    existing = spark.createDataFrame([(1, "a", "a@x.com", TS, TS)], S.CUSTOMERS)
    new = spark.createDataFrame([(None, "a", "a@x.com", None, None),
                                 (None, "b", "b@x.com", None, None),
                                 (None, "c", "c@x.com", TS, TS), (None, "c2", "c@x.com", TS, TS)],
                                S.CUSTOMERS)
    good, bad = add_customers(new, existing)
    g = good.collect()
    assert [r.email for r in g] == ["b@x.com"] and g[0].customer_id is not None
    assert g[0].created_at is not None
    assert sorted(r.error_message for r in bad.collect()) == [
        "Customer email already exists", "Customer email repeated in the batch",
        "Customer email repeated in the batch"]


def test_add_payment_methods_and_items(spark):
    pm_existing = spark.createDataFrame([(1, "Cash", True, TS)], S.PAYMENT_METHODS)
    good, bad = add_payment_methods(
        spark.createDataFrame([(None, "Cash", None, None), (None, "Credit Card", None, None)],
                              S.PAYMENT_METHODS), pm_existing)
    assert [(r.name, r.is_active) for r in good.collect()] == [("Credit Card", True)]
    items = spark.createDataFrame([(None, "Scone", "x", 4.25, TS, TS), (None, "Bad", "x", -1.0, TS, TS)],
                                  S.ITEMS)
    ok, rej = add_items(items)
    assert [r.name for r in ok.collect()] == ["Scone"]
    assert [r.error_message for r in rej.collect()] == ["unit_price must be >= 0"]


def test_result_cache_expires(spark):
    now = [0.0]
    cache = ResultCache(ttl=10, clock=lambda: now[0])
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    cache.get("q", build)
    cache.get("q", build)
    now[0] = 11
    cache.get("q", build)
    assert len(built) == 2
    cache.clear()


def test_reset_and_reload(spark, tmp_root):
    spark.createDataFrame([(9, "Old", None, 1.0, TS, TS)], S.ITEMS).write.parquet(f"{tmp_root}/items")
    sample = spark.createDataFrame([(1, "Scone", None, 4.25, TS, TS)], S.ITEMS)
    rep = reset_and_reload(spark, tmp_root, {"items": sample}, ["items"]).collect()
    assert [(r.rows_before, r.rows_after) for r in rep] == [(1, 0)]
    assert [r.name for r in spark.read.parquet(f"{tmp_root}/items").collect()] == ["Scone"]
