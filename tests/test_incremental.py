import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators.incremental import high_water, incremental_load, newer_than

D = dt.date
TS = dt.datetime


def test_high_water_marks(spark):
    src = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 2)), (3, D(2024, 1, 3))],
                                "id int, d date")
    target = spark.createDataFrame([(9, D(2024, 1, 2))], "id int, d date")
    empty = spark.createDataFrame([], "id int, d date")
    strict = newer_than(src, "d", high_water(target, "d"))
    incl = newer_than(src, "d", high_water(target, "d"), inclusive=True)
    assert sorted(r.id for r in strict.collect()) == [3]          # row on the mark left out
    assert sorted(r.id for r in incl.collect()) == [2, 3]         # row on the mark kept
    # empty target: NULL mark means a full load (not an empty one)
    assert newer_than(src, "d", high_water(empty, "d")).count() == 3


def test_cursor_load_boundary(spark):
    schema = "k string, c timestamp_ntz"
    target = spark.createDataFrame([("a", TS(2024, 1, 1)), ("b", TS(2024, 1, 2))], schema)
    # two rows on the boundary, one (b) already loaded; one older row; one newer row
    src = spark.createDataFrame([("a", TS(2024, 1, 1)), ("b", TS(2024, 1, 2)),
                                 ("x", TS(2024, 1, 2)), ("y", TS(2024, 1, 3)),
                                 ("n", None)], schema)
    out = incremental_load(src, target, "c", ["k"])
    assert sorted(r.k for r in out.collect()) == ["x", "y"]


def test_two_step_load_equals_one(spark):
    rows = [(f"k{i}", TS(2024, 1, 1 + i % 5)) for i in range(20)]
    full = spark.createDataFrame(rows, "k string, c timestamp_ntz")
    first = full.where(F.col("c") <= F.lit(TS(2024, 1, 3)))
    second = incremental_load(full, first, "c", ["k"])
    assert sorted(first.union(second).collect()) == sorted(full.collect())
