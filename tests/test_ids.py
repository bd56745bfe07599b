"""Ids of new rows: hashes where those don't clash, and distinct wherever they do."""

import datetime as dt
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.plans.ingest import add_customers, add_items, ingest_transactions, with_unique_ids

TS = dt.datetime(2024, 1, 1, 8)


def hashed(key, bits):
    return int(hashlib.md5(key.encode()).hexdigest()[:15], 16) & ((1 << bits) - 1)


def ids(spark, keys, given=(), taken=(), bits=4):
    rows = spark.createDataFrame([(None, k) for k in keys] + [(i, f"given {i}") for i in given], "id bigint, k string")
    out = with_unique_ids(rows.repartition(3), "id", F.col("k"), spark.createDataFrame([(i,) for i in taken], "id bigint"), bits)
    assert out.columns == ["id", "k"]
    return {r["k"]: r["id"] for r in out.collect()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text("abcdef", min_size=1, max_size=3), min_size=1, max_size=30), st.sets(st.integers(0, 40), max_size=8),
       st.sets(st.integers(0, 40), max_size=8))
def test_ids_of_four_bits(spark, keys, given, taken):
    """Clashes within the batch, with ids given in it and with ids stored before."""
    got = ids(spark, keys, given, taken)
    assert ids(spark, keys, given, taken) == got  # the same again
    assert all(got[f"given {i}"] == i for i in given)
    new = [got[k] for k in keys]
    assert len(set(new)) == len(new) and set(new).isdisjoint(given | taken)
    assert all(got[k] % 16 == hashed(k, 4) for k in keys)
    for k in keys:
        alone = [x for x in keys if hashed(x, 4) == hashed(k, 4)] == [k]
        if alone and not any(i % 16 == hashed(k, 4) for i in given | taken):
            assert got[k] == hashed(k, 4)


def test_two_batches_and_no_room(spark):
    first = ids(spark, [f"k{i}" for i in range(40)])
    second = ids(spark, [f"m{i}" for i in range(40)], taken=list(first.values()))
    assert len(set(first.values()) | set(second.values())) == 80
    with pytest.raises(Exception, match="more than 8 keys"):
        ids(spark, ["x"], taken=[hashed("x", 60) + (7 << 60)], bits=60)


def test_customers_and_their_transactions_agree(spark):
    """Four-bit ids: forty new customers, the customers' ids distinct, each transaction with its own customer's."""
    n = 40
    headers = spark.createDataFrame(
        [(f"r{i}", f"c{i % n}@x.com", "Cash", "In-store", TS, TS) for i in range(2 * n)],
        "request_id string, customer_email string, payment_method string, location string, created_at timestamp_ntz, updated_at timestamp_ntz")
    lines = spark.createDataFrame([(f"r{i}", 1, "Chai", 1) for i in range(2 * n)],
                                  "request_id string, line_no int, item_name string, quantity bigint")
    customers = spark.createDataFrame([(3, "old", "c0@x.com", TS, TS)], S.CUSTOMERS)
    res = ingest_transactions(headers, lines, customers, spark.createDataFrame([(1, "Chai", "", 2.0, TS, TS)], S.ITEMS),
                              spark.createDataFrame([(1, "Cash", True, TS)], S.PAYMENT_METHODS), id_bits=4)
    of = {r["email"]: r["customer_id"] for r in res.new_customers.collect()} | {"c0@x.com": 3}
    assert len(of) == n == len(set(of.values()))
    email = headers.selectExpr("substr(sha2(request_id, 256), 1, 16) as transaction_id", "customer_email")
    both = res.transactions.join(email, "transaction_id").collect()
    assert len(both) == 2 * n and all(r["customer_id"] == of[r["customer_email"]] for r in both)


def test_added_rows_get_ids_of_their_own(spark):
    have = spark.createDataFrame([(i, f"n{i}", f"e{i}@x.com", TS, TS) for i in range(16)], S.CUSTOMERS)
    new = spark.createDataFrame([(None, f"m{i}", f"f{i}@x.com", None, None) for i in range(20)], S.CUSTOMERS)
    good, bad = add_customers(new, have, id_bits=4)
    got = [r["customer_id"] for r in good.collect()]
    assert len(set(got)) == 20 and set(got).isdisjoint(range(16)) and bad.count() == 0
    items = spark.createDataFrame([(None, "Scone", "x", 1.0, TS, TS)] * 3 + [(None, f"i{i}", None, 1.0, TS, TS) for i in range(20)], S.ITEMS)
    good, _ = add_items(items, spark.createDataFrame([(i, "x", "", 1.0, TS, TS) for i in range(16)], S.ITEMS), id_bits=4)
    got = [r["item_id"] for r in good.collect()]
    assert len(set(got)) == 23 and set(got).isdisjoint(range(16))
