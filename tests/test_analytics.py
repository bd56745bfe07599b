import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.plans import analytics as an
from ledgerline.plans.marts import dim_transaction_items

TS = dt.datetime(2024, 1, 1)
NAMES = ["Mocha", "Chai", "Scone", "Nope"]


@settings(max_examples=8, deadline=None)
@given(static=st.lists(st.tuples(st.sampled_from(NAMES), st.integers(1, 5)), max_size=12),
       live=st.lists(st.tuples(st.integers(1, 6), st.integers(1, 5)), max_size=12),
       versions=st.lists(st.sampled_from(NAMES[:3]), min_size=1, max_size=6))
def test_eager_item_quantity_equals_join_then_sum(spark, static, live, versions):
    items = spark.createDataFrame(
        [(i + 1, n, None, 1.0, TS, TS) for i, n in enumerate(versions)], S.ITEMS)
    ti = spark.createDataFrame(
        [(f"t{i}", item, q, 1.0, float(q), TS) for i, (item, q) in enumerate(live)],
        S.TRANSACTION_ITEMS)
    st_ = spark.createDataFrame(
        [(f"s{i}", n, q, 1.0, float(q), "In-store", "Cash", dt.date(2024, 1, 1))
         for i, (n, q) in enumerate(static)], S.STG_TRANSACTIONS_STATIC)
    slow = an.item_quantity(dim_transaction_items(ti, st_, items), items)
    fast = an.item_quantity_from_models(ti, st_, items, items)
    assert sorted(slow.collect(), key=repr) == sorted(fast.collect(), key=repr)


def test_share_sums_to_one(spark):
    iq = spark.createDataFrame([("a", 3), ("b", 1), (None, 4)], "item_name string, total_quantity long")
    total = sum(r.share for r in an.with_share(iq).collect())
    assert abs(total - 1.0) < 1e-12


def test_monthly_sales_exact_decimal(spark):
    fct = spark.createDataFrame(
        [("t1", None, None, None, 0.1, None, None, dt.date(2024, 1, 3)),
         ("t1", None, None, None, 0.2, None, None, dt.date(2024, 1, 9)),
         ("t2", None, None, None, 0.3, None, None, dt.date(2024, 2, 1))], S.FCT_TRANSACTIONS)
    rows = an.monthly_sales(fct).collect()
    assert [(r.month, r.order_count, str(r.total_sales)) for r in rows] == [
        (dt.date(2024, 1, 1), 1, "0.300000000"), (dt.date(2024, 2, 1), 1, "0.300000000")]


def test_lookup_found_and_missing(spark):
    tx = spark.createDataFrame([("a", 1), ("b", 2)], "transaction_id string, v int")
    ids = spark.createDataFrame([("a",), ("a",), ("z",)], "transaction_id string")
    found, missing = an.get_transactions(tx, ids)
    assert [r.transaction_id for r in found.collect()] == ["a"]
    assert [r.transaction_id for r in missing.collect()] == ["z"]


def test_fanout_join_splits_hot_keys_exactly(spark):
    from ledgerline.operators.joins import fanout_left_join
    left = spark.createDataFrame([(i, k) for i, k in enumerate("aaaabbcx")], "lid int, k string")
    right = spark.createDataFrame([(j, "a") for j in range(7)] + [(10, "b"), (11, "c"), (12, None)],
                                  "rid int, rk string")
    want = sorted(left.join(right, left.k == right.rk, "left").collect(), key=repr)
    for rows_per_task in (1, 2, 3, 100):   # 'a' split in 7, 4, 3 buckets, then not at all
        got = fanout_left_join(left, right, "k", "rk", rows_per_task)
        assert sorted(got.collect(), key=repr) == want
        assert got.columns == ["lid", "k", "rid", "rk"]


def test_static_items_with_tiny_task_budget_matches(spark):
    items = spark.createDataFrame(
        [(i + 1, n, None, 1.0, TS, TS) for i, n in enumerate(["Mocha"] * 5 + ["Chai"] * 2)], S.ITEMS)
    ti = spark.createDataFrame([], S.TRANSACTION_ITEMS)
    st_ = spark.createDataFrame(
        [(f"s{i}", n, 1, 1.0, 1.0, "In-store", "Cash", dt.date(2024, 1, 1))
         for i, n in enumerate(["Mocha", "Mocha", "Chai", "Nope"])], S.STG_TRANSACTIONS_STATIC)
    a = dim_transaction_items(ti, st_, items, rows_per_task=1)
    b = dim_transaction_items(ti, st_, items)
    assert a.count() == 2 * 5 + 2 + 1
    assert sorted(a.collect(), key=repr) == sorted(b.collect(), key=repr)


def test_counted_fanout_join_folds_equal_copies(spark):
    """The sums of the fan-out, from one row for each sale and item id, however many versions the id has."""
    from ledgerline.operators.joins import fanout_left_join, fanout_left_join_counted
    left = spark.createDataFrame([(i, k, i + 1) for i, k in enumerate([*"aaaabbcx", None])], "lid int, k string, q long")
    rows = [(j % 2, "a", j) for j in range(7)] + [(10, "b", 0), (10, "b", 0), (None, "c", 1), (None, "c", 2), (12, None, 3)]
    right = spark.createDataFrame(rows, "rid int, rk string, version int")
    for rows_per_task in (1, 2, 3, 100):
        plain = fanout_left_join(left, right, "k", "rk", rows_per_task).groupBy("lid", "rid") \
            .agg(F.count(F.lit(1)).alias("n"), F.sum("q").alias("q"))
        got = fanout_left_join_counted(left, right, "k", "rk", ["rk", "rid"], "n", rows_per_task)
        assert sorted(got.select("lid", "rid", "n", (F.col("q") * F.col("n")).alias("q")).collect(), key=repr) \
            == sorted(plain.collect(), key=repr)


def test_static_items_with_copies_has_a_row_per_sale_and_item(spark):
    from ledgerline.plans.marts import static_items
    items = spark.createDataFrame([(7, n, str(i), 1.0, TS, TS) for n in ("Mocha", "Chai") for i in range(40)], S.ITEMS)
    sales = spark.createDataFrame(
        [(f"s{i}", n, 2, 1.0, 1.0, "In-store", "Cash", dt.date(2024, 1, 1))
         for i, n in enumerate(["Mocha", "Mocha", "Chai", "Nope"])], S.STG_TRANSACTIONS_STATIC)
    got = static_items(sales, items, rows_per_task=10, copies="copies").collect()
    assert sorted((r.transaction_id, r.item_id, r.copies) for r in got if r.item_id) \
        == [("s0", 7, 40), ("s1", 7, 40), ("s2", 7, 40)]
    assert [(r.transaction_id, r.copies) for r in got if not r.item_id] == [("s3", 1)]
