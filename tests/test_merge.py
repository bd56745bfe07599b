import datetime as dt

import pytest

from ledgerline.operators.merge import DuplicateKeys, merge_upsert

D = dt.date
SCHEMA = "k string, v long, d date"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(spark, path):
    return sorted(((r.k, r.v, r.d) for r in spark.read.parquet(path).collect()), key=repr)


def test_update_insert_move_and_emptied_partition(spark, tmp_root):
    p = f"{tmp_root}/t"
    merge_upsert(spark, p, _df(spark, [("a", 1, D(2024, 1, 1)), ("b", 2, D(2024, 1, 1)),
                                       ("c", 3, D(2024, 1, 2))]), "k", "d")
    # update a, move c to a new date (its old date becomes empty), insert e
    res = merge_upsert(spark, p, _df(spark, [("a", 10, D(2024, 1, 1)), ("c", 3, D(2024, 1, 5)),
                                             ("e", 5, D(2024, 1, 3))]), "k", "d")
    assert _rows(spark, p) == [("a", 10, D(2024, 1, 1)), ("b", 2, D(2024, 1, 1)),
                               ("c", 3, D(2024, 1, 5)), ("e", 5, D(2024, 1, 3))]
    assert res.removed_partitions == [D(2024, 1, 2)]


def test_null_keys_never_match(spark, tmp_root):
    p = f"{tmp_root}/t"
    merge_upsert(spark, p, _df(spark, [(None, 1, D(2024, 1, 1)), ("a", 1, D(2024, 1, 1))]), "k", "d")
    merge_upsert(spark, p, _df(spark, [(None, 2, D(2024, 1, 1))]), "k", "d")
    assert sorted(_rows(spark, p), key=repr) == sorted(
        [(None, 1, D(2024, 1, 1)), (None, 2, D(2024, 1, 1)), ("a", 1, D(2024, 1, 1))], key=repr)


def test_repeated_source_key_raises(spark, tmp_root):
    p = f"{tmp_root}/t"
    merge_upsert(spark, p, _df(spark, [("a", 1, D(2024, 1, 1))]), "k", "d")
    with pytest.raises(DuplicateKeys):
        merge_upsert(spark, p, _df(spark, [("b", 1, D(2024, 1, 1)), ("b", 2, D(2024, 1, 2))]),
                     "k", "d")
    assert _rows(spark, p) == [("a", 1, D(2024, 1, 1))]


def test_latest_on_duplicate(spark, tmp_root):
    p = f"{tmp_root}/t"
    merge_upsert(spark, p, _df(spark, [("b", 1, D(2024, 1, 1)), ("b", 2, D(2024, 1, 2))]),
                 "k", "d", on_duplicate="latest", order_cols=["v"])
    assert _rows(spark, p) == [("b", 2, D(2024, 1, 2))]


def test_merge_twice_equals_once(spark, tmp_root):
    p = f"{tmp_root}/t"
    base = _df(spark, [("a", 1, D(2024, 1, 1)), ("b", 2, D(2024, 1, 2))])
    src = _df(spark, [("b", 20, D(2024, 1, 2)), ("c", 3, D(2024, 1, 3))])
    merge_upsert(spark, p, base, "k", "d")
    merge_upsert(spark, p, src, "k", "d")
    once = _rows(spark, p)
    res = merge_upsert(spark, p, src, "k", "d")
    assert _rows(spark, p) == once
    assert res.touched_partitions == 0  # unchanged rows rewrite nothing


def test_schema_change_fails(spark, tmp_root):
    from ledgerline.operators.incremental import SchemaChanged
    p = f"{tmp_root}/t"
    merge_upsert(spark, p, _df(spark, [("a", 1, D(2024, 1, 1))]), "k", "d")
    bad = spark.createDataFrame([("a", "x", D(2024, 1, 1))], "k string, v string, d date")
    with pytest.raises(SchemaChanged):
        merge_upsert(spark, p, bad, "k", "d")
