import datetime as dt

from ledgerline import schemas as S
from ledgerline.operators.quality import drop_sentinels
from ledgerline.plans.staging import clean_static, stg_transactions_static


def _raw(spark, rows):
    return spark.createDataFrame(rows, S.SALES_CSV)


GOOD = ("TXN_1", "Mocha", "2", "3.75", "7.0", "In-store", "Cash", "2024-01-05")


def test_sentinels_and_nulls_dropped(spark):
    rows = [GOOD,
            ("TXN_2", "ERROR", "2", "3.75", "7.0", "In-store", "Cash", "2024-01-05"),
            ("TXN_3", "Chai", "UNKNOWN", "2.25", "5.0", "Takeaway", "Cash", "2024-01-05"),
            ("TXN_4", "Chai", "1", "2.25", "2.25", None, "Cash", "2024-01-05"),
            ("TXN_5", "error", "1", "2.25", "2.25", "Takeaway", "Cash", "2024-01-05")]
    out = drop_sentinels(_raw(spark, rows)).collect()
    # sentinels are exact and case-sensitive: 'error' stays
    assert sorted(r[0] for r in out) == ["TXN_1", "TXN_5"]


def test_unparseable_values_go_to_rejects(spark):
    rows = [GOOD,
            ("TXN_2", "Chai", "4.0", "2.25", "10.0", "Takeaway", "Cash", "2024-01-05"),
            ("TXN_3", "Chai", "1", "2.25", "2.25", "Takeaway", "Cash", "abc"),
            ("TXN_4", "Chai", " 4 ", "2.25", "10.0", "Takeaway", "Cash", "2024-01-06")]
    good, rejected = clean_static(_raw(spark, rows))
    g = {r.transaction_id: r for r in good.collect()}
    assert set(g) == {"TXN_1", "TXN_4"}
    assert g["TXN_1"].quantity == 2 and g["TXN_1"].transaction_date == dt.date(2024, 1, 5)
    assert g["TXN_4"].quantity == 4
    rej = {r["Transaction ID"]: r.error_message for r in rejected.collect()}
    assert rej == {"TXN_2": "Quantity is not an integer", "TXN_3": "Transaction Date is not a date"}


def test_good_plus_rejected_plus_incomplete_is_input(spark):
    rows = [GOOD, ("TXN_2", "Chai", "x", "2.25", "10.0", "Takeaway", "Cash", "2024-01-05"),
            ("TXN_3", None, "1", "2.25", "2.25", "Takeaway", "Cash", "2024-01-05")]
    raw = _raw(spark, rows)
    good, rejected = clean_static(raw)
    assert good.count() + rejected.count() + 1 == raw.count()


def test_static_model_distinct_and_schema(spark):
    out = stg_transactions_static(_raw(spark, [GOOD, GOOD]))
    assert out.count() == 1
    assert out.schema == S.STG_TRANSACTIONS_STATIC
