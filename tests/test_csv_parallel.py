"""CSV files that are split by block: the same rows as read whole, and many tasks for one file."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.sources.files import files_by_lines, read_sales_csv, read_sales_csv_in_parallel

COLUMNS = ["a", "b"]
HEADER = "a,b\n"


def write(root, **files):
    os.makedirs(root, exist_ok=True)
    for name, body in files.items():
        with open(f"{root}/{name}.csv", "w", newline="") as f:
            f.write(body)
    return root


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# A field as people and programs write it, stray and unbalanced quotes among them.
FIELD = st.sampled_from(["x", "", " ", "tea", '"q"', '"a,b"', '"say ""hi"""', '""', '"two\nlines"', '5" pipe', '"open', 'shut"', '" a"', '"b" ',
                         '"x\r\ny"', "a\tb", '"\n"', '"""', "é"])
FILE = st.lists(st.lists(FIELD, min_size=1, max_size=3).map(",".join), max_size=6).map(lambda x: HEADER + "\n".join(x))


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(FILE, min_size=1, max_size=3))
def test_rows_equal_those_of_whole_files(spark, tmp_path_factory, files):
    root = write(str(tmp_path_factory.mktemp("csv")), **{f"f{i}": x for i, x in enumerate(files)})
    assert rows(read_sales_csv_in_parallel(spark, root, COLUMNS)) == rows(read_sales_csv(spark, root, COLUMNS, True))


@pytest.mark.parametrize("body, plain", [
    ("x,y\n", True), ('"a,b","c ""d"""\n', True), ('"a\nb",c\n', False), ('5" pipe,"a\nb" 6"\n', False), ("  \nx,y\n", False),
    ("x,y,z,w\n\nq\n", True), ("x," + "y" * 20_000 + "\n", False)])
def test_which_files_are_split(spark, tmp_root, body, plain):
    found = files_by_lines(spark, write(f"{tmp_root}/a b%c", f=HEADER + body))
    assert [len(x) for x in found] == ([1, 0] if plain else [0, 1])
    assert os.path.exists((found[0] + found[1])[0].removeprefix("file:").replace("//", "/"))


def test_one_file_is_read_by_many_tasks(spark, tmp_root):
    body = HEADER + "".join(f'{i},"item, no ""{i}"""\n' for i in range(20_000))
    write(tmp_root, big=body, other=HEADER + '"two\nlines",x\n')
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        whole = read_sales_csv(spark, f"{tmp_root}/big.csv", COLUMNS, True)
        split = read_sales_csv_in_parallel(spark, tmp_root, COLUMNS)
        assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 5
        assert split.count() == 20_001 and rows(split.where("_corrupt_record is not null")) == []
        assert rows(split.where("a = '7'")) == [("7", 'item, no "7"', None)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
