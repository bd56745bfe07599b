import json

from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.sinks.load import snapshot
from ledgerline.sinks.reset import reset_tables
from ledgerline.sources.files import read_json_array, read_sales_csv
from ledgerline.streaming.file_load import stream_load


def test_json_root_array(spark, tmp_root):
    doc = {"items": [{"name": "Scone", "description": "plain", "unit_price": 4.25,
                      "created_at": "2023-06-05T11:30:00", "updated_at": "2023-06-05T11:30:00"},
                     {"name": "Chai", "description": None, "unit_price": 2.25,
                      "created_at": "2023-06-05T11:30:00", "updated_at": "2023-06-05T11:30:00"}]}
    p = f"{tmp_root}/new_items.json"
    with open(p, "w") as f:
        json.dump(doc, f, indent=2)
    df = read_json_array(spark, p, "items", S.ITEMS)
    assert sorted((r.name, r.unit_price) for r in df.collect()) == [("Chai", 2.25), ("Scone", 4.25)]


def test_csv_all_text_empty_is_null(spark, tmp_root):
    p = f"{tmp_root}/sales.csv"
    with open(p, "w") as f:
        f.write(",".join(S.SALES_CSV_COLUMNS) + "\n")
        f.write("TXN_1,Mocha,2,3.75,7.0,In-store,Cash,2024-01-05\n")
        f.write("TXN_2,,ERROR,3.75,7.0,In-store,Cash,2024-01-05\n")
    rows = {r["Transaction ID"]: r for r in read_sales_csv(spark, p).collect()}
    assert rows["TXN_1"]["Quantity"] == "2"
    assert rows["TXN_2"]["Item"] is None and rows["TXN_2"]["Quantity"] == "ERROR"


def test_stream_load_resent_snapshot_does_not_pile_up(spark, tmp_root):
    rows = [(f"t{i}", 1, 1, "In-store", float(i), "completed", None, None) for i in range(10)]
    df = spark.createDataFrame(rows, S.TRANSACTIONS).withColumn(
        "updated_at", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,0)")
        + F.expr("make_dt_interval(0, cast(substr(transaction_id, 2) as int))"))
    lake, raw, ck = f"{tmp_root}/lake", f"{tmp_root}/raw", f"{tmp_root}/ck"
    snapshot(df.where("transaction_id < 't5'"), lake)
    stream_load(spark, lake, raw, ck, S.TRANSACTIONS, "updated_at", ["transaction_id"])
    snapshot(df, lake)  # the next hour's snapshot re-sends every row
    stream_load(spark, lake, raw, ck, S.TRANSACTIONS, "updated_at", ["transaction_id"])
    out = spark.read.parquet(raw)
    assert out.count() == 10 and out.select("transaction_id").distinct().count() == 10


def test_reset_tables_report(spark, tmp_root):
    spark.range(5).write.parquet(f"{tmp_root}/items")
    rep = {r.table_name: (r.rows_before, r.rows_after)
           for r in reset_tables(spark, tmp_root, ["items", "customers"]).collect()}
    assert rep == {"items": (5, 0), "customers": (0, 0)}


def _stream(spark, root, rows, **options):
    snapshot(spark.createDataFrame(rows, "k string, c int, x int").repartitionByRange(3, F.col("c").desc_nulls_last()),
             f"{root}/lake")
    schema = spark.createDataFrame([], "k string, c int, x int").schema
    return stream_load(spark, f"{root}/lake", f"{root}/raw", options.pop("checkpoint", f"{root}/ck"), schema, "c", ["k"],
                       max_files_per_trigger=1, **options)


def _loaded(spark, root):
    return sorted((r.k, r.c) for r in spark.read.parquet(f"{root}/raw").collect())


def test_stream_state_knows_what_is_loaded_without_reading_it(spark, tmp_root):
    """Files by falling cursor; rows sent again while the raw table's files are out of reach; a row on the mark sent
    again after the state let go of it."""
    import os
    rows = [(f"k{i}", i, 0) for i in range(9)]
    _stream(spark, tmp_root, rows)
    assert _loaded(spark, tmp_root) == sorted((f"k{i}", i) for i in range(9))
    os.rename(f"{tmp_root}/raw", f"{tmp_root}/aside")
    os.makedirs(f"{tmp_root}/raw")
    rows += [(f"k{i}", i, 0) for i in range(9, 12)] + [("k8", 9, 1), ("m", 8, 0), ("m", 8, 1)]
    _stream(spark, tmp_root, rows)
    assert _loaded(spark, tmp_root) == [("k10", 10), ("k11", 11), ("k8", 9), ("k9", 9), ("m", 8)]
    for more in ([("k12", 12, 0)], [("k13", 13, 0)], [], [("on mark", 13, 0)]):
        rows += more
        _stream(spark, tmp_root, rows)
    assert _loaded(spark, tmp_root) == [("k10", 10), ("k11", 11), ("k12", 12), ("k13", 13), ("k8", 9), ("k9", 9), ("m", 8),
                                        ("on mark", 13)]


def test_stream_that_dies_after_its_write_loads_every_row_once(spark, tmp_root, monkeypatch):
    import pytest

    from ledgerline.streaming import file_load
    rows = [(f"k{i}", i, 0) for i in range(6)] + [(None, None, 1), (None, None, 2)]
    clear, calls = file_load.delete_path, []

    def dies(s, path):
        if path.endswith("-writing") and not calls:
            calls.append(path)
            raise RuntimeError("killed")
        clear(s, path)

    monkeypatch.setattr(file_load, "delete_path", dies)
    with pytest.raises(Exception, match="killed"):
        _stream(spark, tmp_root, rows)
    assert calls
    _stream(spark, tmp_root, rows + [("k6", 6, 0)])
    _stream(spark, tmp_root, rows + [("k6", 6, 0)])
    assert _loaded(spark, tmp_root) == sorted((f"k{i}", i) for i in range(7))
    assert sorted(r.payload for r in spark.read.parquet(f"{tmp_root}/raw_rejected").collect()) == ['{"x":1}', '{"x":2}']


def test_stream_with_a_new_checkpoint_over_a_filled_table(spark, tmp_root):
    rows = [(f"k{i}", i, 0) for i in range(6)]
    _stream(spark, tmp_root, rows)
    _stream(spark, tmp_root, rows + [("k6", 6, 0)], checkpoint=f"{tmp_root}/other")
    assert _loaded(spark, tmp_root) == sorted((f"k{i}", i) for i in range(7))
