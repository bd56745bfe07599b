"""File readers."""

from __future__ import annotations

from typing import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas as S


CORRUPT = "_corrupt_record"


def read_sales_csv(spark: SparkSession, path: str, columns=None,
                   multi_line: bool = True) -> DataFrame:
    """CSV with a header row, every column read as text (S4), and the raw text of malformed
    rows (too few or too many fields) in ``_corrupt_record``, NULL for the others.

    An explicit schema, so no inference pass over the data; the header must match it; an empty
    field reads as NULL.  Fields may be quoted, a quote within one is doubled.  With
    ``multi_line`` a quoted field may hold line feeds, and each file is one split; switch it off
    for files without such fields, which are then split by block and read in parallel.
    """
    cols = columns or S.SALES_CSV_COLUMNS
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in [*cols, CORRUPT]])
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("enforceSchema", False).csv(path))


# A line whose fields are plain (no quote in them) or quoted from end to end, quotes within doubled.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
WHOLE_LINE = f"^{_FIELD}(?:,{_FIELD})*+$"
LONG_LINE = 10_000  # such lines are not matched: the pattern's depth grows with the fields


def _in_doubt(line: Column) -> Column:
    """Not surely a record of its own: a quote is open at an end of the line or stands inside a plain field; the line is
    blank but not empty, or begins with a byte-order mark, which the two ways of reading treat differently."""
    return ((F.length(line) > LONG_LINE) | ~line.rlike(WHOLE_LINE) | ((line != "") & (F.trim(line) == ""))
            | line.startswith("\ufeff") | line.contains("\u0000"))


def files_by_lines(spark: SparkSession, path: str | Sequence[str]) -> tuple[list[str], list[str]]:
    """(files in which each line is a record, the others), by one scan of the lines in parallel.

    Where no line is in doubt, every record begins and ends with its line, so the file reads the same cut at any line
    feed.  One flag a file comes to the driver, which lists the files for the read anyway.
    """
    lines = spark.read.text(list(path) if not isinstance(path, str) else path)
    found = lines.select(F.col("_metadata.file_path").alias("file"), _in_doubt(F.col("value")).alias("doubt")) \
        .groupBy("file").agg(F.max("doubt").alias("doubt")).collect()
    by = {True: [], False: []}
    for r in sorted(found):
        by[bool(r["doubt"])].append(unquote(r["file"]))
    return by[False], by[True]


def read_sales_csv_in_parallel(spark: SparkSession, path: str | Sequence[str], columns=None) -> DataFrame:
    """``read_sales_csv`` with the same rows, each file split by block unless a quoted field may hold line feeds.

    The lines are looked at once before; only files with a line in doubt are read whole.
    """
    plain, whole = files_by_lines(spark, path)
    parts = [read_sales_csv(spark, files, columns, multi_line) for files, multi_line in ((plain, False), (whole, True)) if files]
    if not parts:  # no file holds a line
        return read_sales_csv(spark, path, columns, True)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_json_array(spark: SparkSession, path: str, root: str,
                    element: T.StructType) -> DataFrame:
    """A JSON document holding one array under ``root`` (S5): one row per element.

    A multi-line document is one split (it cannot be cut safely), so this suits the small
    reference files; large feeds should be JSON lines (``spark.read.schema(...).json``).
    """
    schema = T.StructType([T.StructField(root, T.ArrayType(element), True)])
    doc = spark.read.schema(schema).option("multiLine", True).json(path)
    return doc.select(F.inline(F.col(root)))


def read_lake(spark: SparkSession, root: str, table: str, schema: T.StructType | None = None
              ) -> DataFrame:
    """Lake Parquet files of one table, by the table's folder glob (S3)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(f"{root.rstrip('/')}/{table}/*.parquet")
