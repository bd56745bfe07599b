"""Runs kept up by deltas: equal to building everything anew, and resumed where they stopped."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.plans import analytics, incremental_run as run, marts, staging
from tests.test_hourly import _oltp, _seed


def rows(df, columns=None):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=repr)


def whole(oltp, seed):
    """Every model built anew."""
    stg = {t: staging.stage(oltp[t], t) for t in staging.STAGING_COLUMNS}
    static = staging.stg_transactions_static(seed)
    ti = marts.dim_transaction_items(stg["transaction_items"], static, stg["items"])
    fct = marts.fct_transactions(stg["transactions"], static, stg["payment_methods"])
    return {"ti": ti, "fct": fct, "monthly": analytics.monthly_sales(fct), "items": analytics.item_quantity(ti, stg["items"])}


def check(store, oltp, seed):
    want = whole(oltp, seed)
    assert rows(store.transaction_items(), marts.TI_COLUMNS) == rows(want["ti"], marts.TI_COLUMNS)
    assert rows(store.facts(), marts.FCT_COLUMNS) == rows(want["fct"], marts.FCT_COLUMNS)
    assert rows(store.monthly_sales()) == rows(want["monthly"])
    assert rows(store.item_quantity()) == rows(want["items"])


def with_items(oltp, spark, more):
    return {**oltp, "items": oltp["items"].unionByName(spark.createDataFrame(more, S.ITEMS))}


def sale(i, item, day, method="Cash"):
    return (f"TXN_{i}", item, "2", "3.0", "6.0", "In-store", method, f"2024-01-{day:02d}")


def test_runs_equal_a_full_build(spark, tmp_root, by_month=False):
    """New lines; sales past the mark; an item that an old sale waited for; a second version of a known item."""
    seed = [sale(1, "Mocha", 5), sale(2, "Flat White", 6), sale(3, "Nothing", 6)]
    first = spark.createDataFrame(seed, S.SALES_CSV)
    store = run.Store(spark, tmp_root, by_month)
    run.run_incremental(spark, _oltp(spark, 2), first, tmp_root, (), by_month)
    check(store, _oltp(spark, 2), first)
    later = dt.datetime(2024, 2, 1)
    oltp = with_items(_oltp(spark, 5), spark, [(3, "Flat White", "", 4.0, later, later), (4, "Mocha", "", 4.5, later, later)])
    second = spark.createDataFrame(seed + [sale(4, "Flat White", 9), sale(5, "Mocha", 9), sale(6, "None yet", 9)], S.SALES_CSV)
    version = store.model("dim_transaction_items").manifest().version
    run.run_incremental(spark, oltp, second, tmp_root, (), by_month)
    check(store, oltp, second)
    # The second run added to the lines and the matched sales; it did not write them anew.
    for origin in (run.LIVE, run.STATIC):
        assert store.model("dim_transaction_items").added_since(version, f"{run.ORIGIN}={origin}") is not None
    versions = {m: store.model(m).versions() for m in ("dim_transaction_items", "fct_transactions", "monthly_sales", "item_quantity")}
    report = run.run_incremental(spark, oltp, second, tmp_root, (), by_month)
    assert {m: store.model(m).versions() for m in versions} == versions  # nothing new: no version
    assert sum(report.steps[f"load_{t}"].written for t in oltp) == 0


def test_compaction_between_runs_takes_no_delta_away(spark, tmp_root):
    """Tables compacted and vacuumed as far as may be after each run: the third run still adds only what is new."""
    seed, store = _seed(spark), run.Store(spark, tmp_root, by_month=True)
    for day in (2, 3):
        run.run_incremental(spark, _oltp(spark, day), seed, tmp_root, (), by_month=True)
        run.tidy(store, list(_oltp(spark, 1)), keep=2, most_slices=1)
    for name in ("transactions", "transaction_items"):
        assert all(s.merged for s in store.staging(name).manifest().slices)
    version = store.model("dim_transaction_items").manifest().version
    run.run_incremental(spark, _oltp(spark, 5), seed, tmp_root, (), by_month=True)
    check(store, _oltp(spark, 5), seed)
    assert store.model("dim_transaction_items").added_since(version, f"{run.ORIGIN}={run.LIVE}").count() == 2


def test_changed_transactions_replace_their_facts(spark, tmp_root):
    seed, store = _seed(spark), run.Store(spark, tmp_root)
    run.run_incremental(spark, _oltp(spark, 3), seed, tmp_root, ())
    oltp = _oltp(spark, 4)
    changed = F.col("transaction_id") == "t2"
    newer = (oltp["transactions"].where(changed).withColumn("total_spent", F.lit(99.0))
             .withColumn("updated_at", F.lit(dt.datetime(2024, 3, 9)).cast("timestamp_ntz")))
    oltp["transactions"] = oltp["transactions"].where(~changed).unionByName(newer)
    run.run_incremental(spark, oltp, seed, tmp_root, ())
    facts = {r["transaction_id"]: r["total_spent"] for r in store.facts().collect()}
    assert facts["t2"] == 99.0 and len(facts) == 4 + 2
    assert rows(store.monthly_sales()) == rows(analytics.monthly_sales(store.facts()))


@pytest.mark.parametrize("broken", ["stage", "fact"])
def test_a_run_that_dies_goes_on(spark, tmp_root, monkeypatch, broken):
    """Whatever step fails in the second run, the third ends as a full build, and the ledger names the step."""
    seed, store = _seed(spark), run.Store(spark, tmp_root)
    run.run_incremental(spark, _oltp(spark, 2), seed.where("`Transaction Date` < '2024-01-06'"), tmp_root, ())
    with monkeypatch.context() as m:
        m.setattr(run, broken, lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run.run_incremental(spark, _oltp(spark, 4), seed, tmp_root, ())
    run.run_incremental(spark, _oltp(spark, 5), seed, tmp_root, ())
    check(store, _oltp(spark, 5), seed)
    failed = run.run_ledger(store).where("status = 'failed'").collect()
    assert {f["step"] for f in failed} == ({f"stg_{t}" for t in staging.STAGING_COLUMNS} if broken == "stage" else {"fct_transactions"})
    assert all(f["error"].startswith("ZeroDivisionError") for f in failed)


def test_second_staging_reads_the_touched_months_only(spark, tmp_root):
    store = run.Store(spark, tmp_root)
    when = lambda m: dt.datetime(2024, m, 3)
    tx = lambda months: spark.createDataFrame(
        [(f"t{m}", 1, 1, "In-store", 1.0, "completed", when(m), when(m)) for m in months], S.TRANSACTIONS)
    for months in ([1, 2, 3], [1, 2, 3, 4]):
        store.lake("transactions").replace(tx(months))
        run.load(store, "transactions")
        if months[-1] == 4:
            plan = run.stage_delta(store, "transactions")._jdf.queryExecution().toString()
            assert "slice=2024-01" not in plan and "slice=2024-02" not in plan
        run.stage(store, "transactions")
    assert store.staging("transactions").read().count() == 4
    assert [s.folder for s in store.staging("transactions").manifest().slices if s.version == 2] == ["slice=2024-04-01"]


def test_repeated_rows_are_staged_once(spark, tmp_root):
    """Repeats within a snapshot, and a row on the mark that another load brings again under another key."""
    store = run.Store(spark, tmp_root)
    at = dt.datetime(2024, 1, 1)
    one = [("t1", 1, 1, 2.0, 2.0, at)]
    for lines in (one * 3, one + [("t2", 1, 1, 2.0, 2.0, at)] * 2):
        store.lake("transaction_items").replace(spark.createDataFrame(lines, S.TRANSACTION_ITEMS))
        run.load(store, "transaction_items")
        run.stage(store, "transaction_items")
    assert sorted(r["transaction_id"] for r in store.staging("transaction_items").read().collect()) == ["t1", "t2"]


def test_late_rows_are_set_aside_once_and_rows_add_up(spark, tmp_root):
    store = run.Store(spark, tmp_root)
    run.static_model(store, spark.createDataFrame([sale(1, "Mocha", 5), sale(2, "Chai", 7)], S.SALES_CSV))
    seed = spark.createDataFrame([sale(1, "Mocha", 5), sale(2, "Chai", 7), sale(3, "Chai", 7), sale(4, "Chai", 6),
                                  sale(5, "Chai", 8), sale(6, "ERROR", 8), (*sale(7, "Chai", 8)[:2], "x", *sale(7, "Chai", 8)[3:])],
                                 S.SALES_CSV)
    for _ in range(2):
        counts = run.static_model(store, seed)
    late = spark.read.parquet(store.quarantine("late_static"))
    assert sorted(r["row_key"] for r in late.collect()) == ["TXN_3", "TXN_4"]
    assert counts.read == 7 == counts.written + counts.known + counts.rejected
    assert sorted(r["transaction_id"] for r in store.model("stg_transactions_static").read().collect()) == ["TXN_1", "TXN_2", "TXN_5"]


def test_the_seed_is_read_once(spark, tmp_root):
    """The static step takes its fates, its rejected rows and its count from one pass over the seed."""
    data = [sale(1, "Mocha", 5), sale(2, "ERROR", 8), (*sale(3, "Chai", 8)[:2], "x", *sale(3, "Chai", 8)[3:])]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    seed = spark.createDataFrame(data, S.SALES_CSV).coalesce(1)
    counts = run.static_model(run.Store(spark, tmp_root), seed.mapInArrow(counted, seed.schema))
    assert seen.value == len(data) == counts.read
    assert rows(staging.rejected_of(staging.with_fates(seed, "bad"), "bad")) == rows(staging.rejected_static(seed))


def test_second_staging_groups_new_and_old_rows_in_one_shuffle(spark, tmp_root):
    store = run.Store(spark, tmp_root)
    when = dt.datetime(2024, 1, 3)
    for names in ("a", "ab"):
        store.lake("transactions").replace(spark.createDataFrame(
            [(n, 1, None, "In-store", 1.0, "completed", when, when) for n in names], S.TRANSACTIONS))
        run.load(store, "transactions")
        if names == "ab":
            delta = run.stage_delta(store, "transactions")
            assert delta._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
            assert [r["transaction_id"] for r in delta.collect()] == ["b"]
        run.stage(store, "transactions")


def test_rows_past_the_mark_are_not_joined(spark, tmp_root):
    from ledgerline.operators.cursor_state import load_by_state, new_by_state
    from ledgerline.operators.incremental import incremental_load
    when = lambda d: dt.datetime(2024, 1, d)
    tx = lambda n: spark.createDataFrame(
        [(f"t{d}", 1, 1, "In-store", 1.0, "completed", when(d), when(d)) for d in range(1, n)] +
        [("t0", 1, 1, "In-store", 1.0, "completed", when(n - 1), when(n - 1))] * (n - 3), S.TRANSACTIONS)
    raw = run.Store(spark, tmp_root).raw("transactions")
    load_by_state(raw, tx(3), "updated_at", ["transaction_id"])
    for new in (new_by_state(raw, tx(5), "updated_at", ["transaction_id"]),
                incremental_load(tx(5), raw.read(), "updated_at", ["transaction_id"])):
        assert sorted(r["transaction_id"] for r in new.collect()) == ["t0", "t0", "t3", "t4"]
        plan = new._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lstrip().startswith("Union")
