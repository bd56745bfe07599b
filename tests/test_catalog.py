"""Tables published under a name, and results kept by version."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators.versioned_merge import merge_versioned
from ledgerline.sinks.cache import ResultCache
from ledgerline.sinks.catalog import create_database, partitions, publish, published_version, save_tables, truncate_tables
from ledgerline.sinks.versioned import VersionedTable

D = dt.date


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_publish_writes_what_changed(spark, tmp_root):
    create_database(spark, "shop_published", f"{tmp_root}/db")
    t = VersionedTable(spark, f"{tmp_root}/t", "d")
    df = lambda *rows: spark.createDataFrame(rows, "d date, k string, v long")
    merge_versioned(t, df((D(2024, 1, 1), "a", 1), (D(2024, 1, 2), "b", 2), (None, "n", 0)), "k")
    publish(t, "shop_published", "facts")
    before = spark.table("shop_published.facts").select("k", F.input_file_name()).where("k = 'a'").first()[1]
    merge_versioned(t, df((D(2024, 1, 3), "b", 5)), "k")  # a key moves, its old partition empties
    assert publish(t, "shop_published", "facts") == ["d=2024-01-02", "d=2024-01-03"]
    assert rows_of(spark.table("shop_published.facts").select("d", "k", "v")) == rows_of(t.read())
    assert sorted(partitions(spark, "shop_published", "facts")) == ["d=2024-01-01", "d=2024-01-03", "d=__HIVE_DEFAULT_PARTITION__"]
    assert published_version(spark, "shop_published", "facts") == t.manifest().version
    assert spark.table("shop_published.facts").select("k", F.input_file_name()).where("k = 'a'").first()[1] == before
    assert publish(t, "shop_published", "facts") == []
    t.vacuum(keep=1)
    t.replace(df((D(2024, 1, 9), "z", 9)))
    t.vacuum(keep=1)  # the published version is gone: the table is published whole
    publish(t, "shop_published", "facts")
    assert rows_of(spark.table("shop_published.facts").select("d", "k", "v")) == [(D(2024, 1, 9), "z", 9)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_plain_tables_and_truncation(spark, tmp_root):
    create_database(spark, "shop_plain", f"{tmp_root}/db")
    t = VersionedTable(spark, f"{tmp_root}/t")
    for i in range(2):
        t.append(spark.createDataFrame([(i,)], "v long"))
        publish(t, "shop_plain", "numbers")
    assert rows_of(spark.table("shop_plain.numbers")) == [(0,), (1,)]
    save_tables(spark, "shop_plain", {"one": spark.range(3), "two": spark.range(2)})
    assert rows_of(truncate_tables(spark, "shop_plain", ["two", "one"])) == [("one", 3, 0), ("two", 2, 0)]
    assert spark.table("shop_plain.one").columns == ["id"]


def test_kept_results_go_with_their_version(spark):
    cache, built = ResultCache(), []

    def build():
        built.append(1)
        return spark.range(len(built))

    assert [cache.get("q", build, v).count() for v in (1, 1, 2, 2, 1)] == [1, 1, 2, 2, 3]
    cache.clear()
