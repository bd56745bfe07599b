"""Versioned tables, merges into them and cursor loads that keep their state."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators.cursor_state import load_by_state, new_by_state, read_state, stored_cursors
from ledgerline.operators.incremental import SchemaChanged
from ledgerline.operators.merge import DuplicateKeys, merge_upsert
from ledgerline.operators.versioned_merge import merge_versioned
from ledgerline.sinks.versioned import ConcurrentCommit, Manifest, VersionedTable

D = dt.date
SCHEMA = "k string, v long, d date"


class Dies(RuntimeError):
    pass


def die():
    raise Dies


def df_of(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_append_replace_and_old_versions(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", "d")
    assert not t.exists() and t.manifest() is None and t.state() == {}
    one, two = [("a", 1, D(2024, 1, 1)), (None, 2, None)], [("c", 3, D(2024, 1, 1))]
    t.append(df_of(spark, one), state={"x": 1})
    before = t.read()
    t.append(df_of(spark, two), state={"y": 2})
    assert rows_of(t.read()) == sorted(one + two, key=repr) and t.state() == {"x": 1, "y": 2}
    assert rows_of(t.read(version=1)) == rows_of(before) == sorted(one, key=repr)
    assert rows_of(t.read([None])) == [(None, 2, None)]
    assert rows_of(t.added_since(1)) == two and t.changed_since(1) == {"d=2024-01-01"}
    t.replace(df_of(spark, two))
    assert rows_of(t.read()) == two and t.added_since(2) is None
    assert rows_of(before) == sorted(one, key=repr)  # until vacuumed, a reader keeps its version


def test_only_named_and_written_partitions_are_replaced(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", "d")
    t.append(df_of(spark, [("a", 1, D(2024, 1, 1)), ("b", 2, D(2024, 1, 2)), ("c", 3, D(2024, 1, 3))]))
    t.replace_partitions(df_of(spark, [("z", 9, D(2024, 1, 2))]), [D(2024, 1, 1)])
    assert rows_of(t.read()) == [("c", 3, D(2024, 1, 3)), ("z", 9, D(2024, 1, 2))]
    t.replace_folders(df_of(spark, [("y", 8, D(2024, 1, 3))]), [D(2024, 1, 2)])
    assert rows_of(t.read()) == [("c", 3, D(2024, 1, 3)), ("y", 8, D(2024, 1, 3))]
    assert rows_of(t.added_since(2, "d=2024-01-03")) == [("y", 8, D(2024, 1, 3))]
    assert t.added_since(2, "d=2024-01-02") is None


def test_text_partitions_and_empty_tables(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", "p")
    rows = [(1, "a/b=c: [x]*"), (2, ""), (3, None), (4, "1")]
    t.append(df_of(spark, rows, "v long, p string"))
    assert rows_of(t.read()) == sorted([(1, "a/b=c: [x]*"), (2, None), (3, None), (4, "1")], key=repr)
    assert rows_of(t.read(["a/b=c: [x]*", "1"])) == [(1, "a/b=c: [x]*"), (4, "1")]
    t.replace(df_of(spark, [], "v long, p string"))
    assert t.read().collect() == [] and t.read().columns == ["v", "p"]
    plain = VersionedTable(spark, f"{tmp_root}/plain")
    plain.append(df_of(spark, [], "v long"))
    plain.append(df_of(spark, [(1,)], "v long"))
    assert rows_of(plain.read()) == [(1,)]


def test_schema_change_and_second_writer_fail(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", "d")
    t.append(df_of(spark, [("a", 1, D(2024, 1, 1))]))
    with pytest.raises(SchemaChanged):
        t.append(df_of(spark, [("a", "x", D(2024, 1, 1))], "k string, v string, d date"))
    base = t.manifest()
    other = VersionedTable(spark, t.path, "d")
    with pytest.raises(ConcurrentCommit):  # the other writer commits while this one writes
        t.append(df_of(spark, [("b", 2, D(2024, 1, 1))]),
                 before_commit=lambda: other._commit(Manifest(base.version + 1, base.schema, base.slices)))
    assert rows_of(t.read()) == [("a", 1, D(2024, 1, 1))]


def test_vacuum_keeps_what_kept_versions_name(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t")
    for i in range(4):
        t.replace(df_of(spark, [(i,)], "v long"))
    with pytest.raises(Dies):
        t.append(df_of(spark, [(9,)], "v long"), before_commit=die)
    assert len(t.vacuum(keep=2)) == 2 and rows_of(t.read(version=3)) == [(2,)]
    with pytest.raises(FileNotFoundError):
        t.read(version=1)
    assert len(t.vacuum(keep=1, orphans=True)) == 2 and rows_of(t.read()) == [(3,)]


def test_compaction_keeps_rows_and_state(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", "d")
    rows = [(str(i), i, D(2024, 1, 1 + i % 2)) for i in range(6)]
    for r in rows[:5]:
        t.append(df_of(spark, [r]), state={"n": r[1]})
    assert t.compact(most_slices=4) is None and t.compact(most_slices=2, small_bytes=1) is None
    t.compact(most_slices=2)
    assert rows_of(t.read()) == rows_of(df_of(spark, rows[:5])) and t.state() == {"n": 4}
    assert [(s.version, s.merged) for s in t.manifest().slices if s.folder == "d=2024-01-01"] == [(5, True)]
    # Who had read version 5 sees nothing new; who had read less can't tell merged rows apart.
    assert t.added_since(5).collect() == [] and t.added_since(4) is None
    assert rows_of(t.added_since(4, "d=2024-01-02")) == []
    t.append(df_of(spark, rows[5:]))
    assert rows_of(t.added_since(5)) == rows_of(df_of(spark, rows[5:]))
    t.replace_partitions(df_of(spark, [("z", 9, D(2024, 1, 1))]))
    assert t.added_since(5) is None and rows_of(t.added_since(5, "d=2024-01-02")) == rows_of(df_of(spark, rows[5:]))


def test_write_given_up_leaves_no_version(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t")
    t.append(df_of(spark, [(1,)], "v long"))
    t.append(df_of(spark, [(2,)], "v long"), state=lambda seen, rows: None)
    assert t.versions() == [1] and rows_of(t.read()) == [(1,)] and t.vacuum(keep=1, orphans=True) == []


# --- merges ------------------------------------------------------------------------------------

def test_merge_dies_before_its_commit(spark, tmp_root):
    """Update, insert, a key that moves and a partition that empties: all or nothing."""
    t = VersionedTable(spark, f"{tmp_root}/t", "d")
    first = [("a", 1, D(2024, 1, 1)), ("b", 2, D(2024, 1, 1)), ("c", 3, D(2024, 1, 2))]
    src = df_of(spark, [("a", 10, D(2024, 1, 1)), ("c", 3, D(2024, 1, 5)), ("e", 5, D(2024, 1, 3))])
    merge_versioned(t, df_of(spark, first), "k")
    with pytest.raises(Dies):
        merge_versioned(t, src, "k", before_commit=die)
    assert rows_of(t.read()) == first
    done = merge_versioned(t, src, "k")
    assert rows_of(t.read()) == [("a", 10, D(2024, 1, 1)), ("b", 2, D(2024, 1, 1)), ("c", 3, D(2024, 1, 5)),
                                 ("e", 5, D(2024, 1, 3))]
    assert done.touched == [D(2024, 1, d) for d in (1, 2, 3, 5)]
    assert "d=2024-01-02" not in t.manifest().folders()
    assert merge_versioned(t, src, "k").version == done.version  # nothing new: no version


def test_merge_of_new_keys_rewrites_nothing(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", "d")
    merge_versioned(t, df_of(spark, [("a", 1, D(2024, 1, 1)), (None, 0, D(2024, 1, 1))]), "k")
    old = set(t.manifest().slices)
    merge_versioned(t, df_of(spark, [("b", 2, D(2024, 1, 1)), (None, 7, D(2024, 1, 2))]), "k", state={"s": 1})
    assert old < set(t.manifest().slices) and t.state() == {"s": 1}
    assert rows_of(t.added_since(1)) == sorted([("b", 2, D(2024, 1, 1)), (None, 7, D(2024, 1, 2))], key=repr)


def test_repeated_source_keys(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/t", "d")
    twice = df_of(spark, [("b", 1, D(2024, 1, 1)), ("b", 2, D(2024, 1, 2))])
    with pytest.raises(DuplicateKeys):
        merge_versioned(t, twice, "k")
    assert not t.exists()
    merge_versioned(t, twice, "k", on_duplicate="latest", order_cols=["v"])
    assert rows_of(t.read()) == [("b", 2, D(2024, 1, 2))]


KEYS = st.sampled_from([None, "a", "b", "c", "d"])
BATCH = st.lists(st.tuples(KEYS, st.integers(0, 3), st.sampled_from([D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)])), min_size=1, max_size=5)


def one_per_key(rows):
    last = {r[0]: r for r in rows if r[0] is not None}
    return list(last.values()) + [r for r in rows if r[0] is None]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(BATCH, min_size=2, max_size=3))
def test_merges_equal_those_into_plain_parquet(spark, tmp_path_factory, batches):
    root = str(tmp_path_factory.mktemp("merge"))
    t = VersionedTable(spark, f"{root}/versioned", "d")
    for rows in batches:
        rows = one_per_key(rows)
        merge_versioned(t, df_of(spark, rows), "k")
        merge_upsert(spark, f"{root}/plain", df_of(spark, rows), "k", "d")
    assert rows_of(t.read()) == rows_of(spark.read.parquet(f"{root}/plain").select("k", "v", "d"))


# --- cursor loads --------------------------------------------------------------------------------

LOAD = "k string, c timestamp_ntz, x long"
T = lambda d: dt.datetime(2024, 1, d)


def test_boundary_rows_are_loaded_once(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/raw")
    rows = [("a", T(1), 1), ("b", T(2), 2), ("n", None, 0)]
    assert load_by_state(t, df_of(spark, rows, LOAD), "c", ["k"]) == 2
    assert read_state(t)["mark"] == "2024-01-02 00:00:00" and read_state(t)["keys"] == 1
    rows += [("x", T(2), 3), (None, T(2), 4), ("late", T(1), 5)]
    assert load_by_state(t, df_of(spark, rows, LOAD), "c", ["k"]) == 2  # the mark stays, its keys grow
    assert read_state(t)["keys"] == 3 and len(read_state(t)["boundary"]) == 2
    assert load_by_state(t, df_of(spark, rows, LOAD), "c", ["k"]) == 0 and t.versions() == [1, 2]
    rows += [("y", T(3), 6)]
    assert load_by_state(t, df_of(spark, rows, LOAD), "c", ["k"]) == 1
    assert read_state(t)["keys"] == 1 and len(read_state(t)["boundary"]) == 1
    assert [r[0] for r in rows_of(t.read())] == ["a", "b", "x", "y", None]
    assert rows_of(stored_cursors(spark, {"t": t})) == [("t", "c", "2024-01-03 00:00:00", 1, 3)]


def test_load_that_dies_and_is_repeated(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/raw")
    first, then = [("a", T(1), 1)], [("a", T(1), 1), ("b", T(1), 2), ("c", T(2), 3)]
    with pytest.raises(Dies):
        load_by_state(t, df_of(spark, first, LOAD), "c", ["k"], before_commit=die)
    assert not t.exists()
    load_by_state(t, df_of(spark, first, LOAD), "c", ["k"])
    for _ in range(2):
        with pytest.raises(Dies):
            load_by_state(t, df_of(spark, then, LOAD), "c", ["k"], before_commit=die)
    assert load_by_state(t, df_of(spark, then, LOAD), "c", ["k"]) == 2
    assert rows_of(t.read()) == then


def test_load_reads_no_loaded_row(spark, tmp_root):
    """The plan of the next load scans the source and the keys on the mark; the source's scan has the mark's filter."""
    t = VersionedTable(spark, f"{tmp_root}/raw")
    df_of(spark, [("a", T(1), 1), ("b", T(2), 2)], LOAD).write.parquet(f"{tmp_root}/src")
    src = spark.read.parquet(f"{tmp_root}/src")
    load_by_state(t, src, "c", ["k"])
    plan = new_by_state(t, src, "c", ["k"])._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "raw/data" not in plan and "raw/boundary" in plan
    assert "GreaterThanOrEqual(c,2024-01-02T00:00)" in plan


def test_text_cursor_and_empty_source(spark, tmp_root):
    t = VersionedTable(spark, f"{tmp_root}/raw")
    from ledgerline.functions.scalar import to_date_safe
    src = df_of(spark, [("a", "2024-01-02"), ("b", "UNKNOWN"), ("c", None)], "k string, c string")
    assert load_by_state(t, src.where(F.lit(False)), "c", ["k"], to_date_safe("c")) == 0
    assert t.exists() and read_state(t)["mark"] is None
    assert load_by_state(t, src, "c", ["k"], to_date_safe("c")) == 1
    assert load_by_state(t, src, "c", ["k"], to_date_safe("c")) == 0
