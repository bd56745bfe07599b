import datetime as dt

from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.functions.scalar import (email_local_part, is_blank, month_start, names_unique,
                                         short_id, strip, strip_lower, within_length)
from ledgerline.plans.models import ShopModels
from ledgerline.sinks.load import load_all, materialize

T0 = dt.datetime(2024, 1, 1)


def test_scalar_functions(spark):
    df = spark.createDataFrame([(" \tA.B@X.com\n", "", ["a", "b", "a"], dt.date(2024, 5, 17))],
                               "e string, b string, arr array<string>, d date")
    r = df.select(strip("e").alias("s"), strip_lower("e").alias("sl"), is_blank("b").alias("bl"),
                  email_local_part(strip_lower("e")).alias("lp"),
                  within_length("e", 5).alias("w5"), within_length(F.lit(None).cast("string"), 1)
                  .alias("wnull"), names_unique(F.col("arr")).alias("u"),
                  month_start("d").alias("m"), short_id(F.col("e")).alias("id1"),
                  short_id(F.col("e")).alias("id2")).first()
    assert r.s == "A.B@X.com" and r.sl == "a.b@x.com" and r.bl is True and r.lp == "a.b"
    assert r.w5 is False and r.wnull is True and r.u is False
    assert r.m == dt.date(2024, 5, 1)
    assert r.id1 == r.id2 and len(r.id1) == 16


def test_models_from_catalog_and_materialize(spark, tmp_root):
    items = spark.createDataFrame([(1, "Mocha", "", 3.5, T0, T0), (1, "Mocha", "", 3.5, T0, T0)],
                                  S.ITEMS)
    items.createOrReplaceTempView("shop_items")
    m = ShopModels.from_catalog(spark, {"items": "shop_items"})
    assert m.stg_items.count() == 1                      # full-row distinct
    v = materialize(m.dim_items, "dim_items_v", "view")
    t = materialize(m.dim_items, "dim_items_t", "table", path=f"{tmp_root}/dim_items")
    assert v.count() == t.count() == 1
    load_all({"a": items, "b": items}, f"{tmp_root}/raw")
    load_all({"a": items}, f"{tmp_root}/raw")
    assert spark.read.parquet(f"{tmp_root}/raw/a").count() == 4
    assert spark.read.parquet(f"{tmp_root}/raw/b").count() == 2
