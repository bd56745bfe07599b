import datetime as dt

from ledgerline import schemas as S
from ledgerline.plans.ingest import flatten_requests, ingest_transactions

TS = dt.datetime(2024, 2, 1, 9, 0)


def _refs(spark):
    items = spark.createDataFrame([
        (1, "Mocha", "", 3.0, TS, dt.datetime(2024, 1, 1)),
        (2, "Mocha", "", 3.75, TS, dt.datetime(2024, 1, 5)),   # newer price wins
        (3, "Chai", "", 2.25, TS, dt.datetime(2024, 1, 1)),
        (4, "Scone", "", 4.25, TS, dt.datetime(2024, 1, 1))], S.ITEMS)
    pms = spark.createDataFrame([(1, "Cash", True, TS), (2, "Credit Card", True, TS)],
                                S.PAYMENT_METHODS)
    customers = spark.createDataFrame([(7, "a.b", "a.b@x.com", TS, TS)], S.CUSTOMERS)
    return items, pms, customers


def _requests(spark, reqs):
    schema = "request_id string, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in S.TRANSACTION_REQUEST.fields)
    return spark.createDataFrame(reqs, schema)


def R(rid, email, items, pm="Cash", loc="In-store"):
    return (rid, email, [{"item_name": n, "quantity": q} for n, q in items], pm, loc, TS, TS)


def test_rules_and_all_or_nothing(spark):
    items, pms, customers = _refs(spark)
    reqs = _requests(spark, [
        R("ok", " A.B@X.com ", [("Mocha", 2), (" Chai ", 1)]),
        R("blank", "  ", [("Chai", 1)]),
        R("dup", "new@y.com", [("Chai", 1), ("Chai ", 2)]),
        R("qty0", "new@y.com", [("Chai", 0)]),
        R("loc", "new@y.com", [("Chai", 1)], loc="Delivery"),
        R("pay", "new@y.com", [("Chai", 1)], pm="Bitcoin"),
        R("item", "new@y.com", [("Chai", 1), ("Nope", 1), ("Scone", 1)]),
        R("empty", "new@y.com", []),
        R("new", "New@Y.com", [("Scone", 2)]),
    ])
    headers, lines = flatten_requests(reqs)
    res = ingest_transactions(headers, lines, customers, items, pms)
    errors = {r.transaction_id: r.error_message for r in res.errors.collect()}
    good_ids = {r.request_id for r in res.good_requests.collect()}
    assert good_ids == {"ok", "new"}
    assert len(errors) == 7
    msgs = sorted(errors.values())
    assert "Customer email cannot be empty" in msgs
    assert "Duplicate items are not allowed in the same transaction" in msgs
    assert "Quantity must be greater than 0" in msgs
    assert 'Location must be either "In-store" or "Takeaway"' in msgs
    assert "Payment method not found" in msgs
    assert "Item not found" in msgs
    assert "At least one item is required" in msgs
    # the request with one unknown item among three adds no line at all
    tx = {r.customer_id: r for r in res.transactions.collect()}
    assert 7 in tx and tx[7].total_spent == 2 * 3.75 + 2.25   # latest Mocha price
    lines_out = res.transaction_items.collect()
    assert sorted((r.item_id, r.quantity) for r in lines_out) == [(2, 2), (3, 1), (4, 2)]
    new = res.new_customers.collect()
    assert [(r.email, r.name) for r in new] == [("new@y.com", "new")]


def test_good_plus_rejected_is_input(spark):
    items, pms, customers = _refs(spark)
    reqs = _requests(spark, [R(str(i), f"u{i}@x.com", [("Chai", i % 3)]) for i in range(30)])
    headers, lines = flatten_requests(reqs)
    res = ingest_transactions(headers, lines, customers, items, pms)
    assert res.good_requests.count() + res.errors.count() == 30
    assert res.transactions.select("transaction_id").distinct().count() == res.transactions.count()


def test_total_is_sum_of_item_subtotals(spark):
    """The total comes from the per-request roll-up, not from the written item lines; the
    two must agree, also for a request whose lines are spread over many tasks."""
    n = 300
    items = spark.createDataFrame(
        [(i, f"Item {i}", "", round(0.1 * i + 0.05, 2), TS, TS) for i in range(1, n + 1)],
        S.ITEMS)
    _, pms, customers = _refs(spark)
    reqs = _requests(spark, [
        R("big", "a.b@x.com", [(f"Item {i}", 1 + i % 4) for i in range(1, n + 1)]),
        R("small", "c@x.com", [("Item 3", 2), ("Item 7", 5)]),
    ])
    headers, lines = flatten_requests(reqs)
    res = ingest_transactions(headers, lines.repartition(16), customers, items, pms)
    tx = {r.transaction_id: r.total_spent for r in res.transactions.collect()}
    sums = {}
    for r in res.transaction_items.collect():
        sums[r.transaction_id] = sums.get(r.transaction_id, 0.0) + r.subtotal
    assert len(tx) == 2 and set(tx) == set(sums)
    for tid, total in tx.items():
        assert abs(total - sums[tid]) < 1e-6
    prices = {i: round(0.1 * i + 0.05, 2) for i in range(1, n + 1)}
    expected_big = sum(prices[i] * (1 + i % 4) for i in range(1, n + 1))
    assert any(abs(t - expected_big) < 1e-6 for t in tx.values())
    assert any(abs(t - (prices[3] * 2 + prices[7] * 5)) < 1e-9 for t in tx.values())
