"""First load of the historical sales file into the raw static table.

Skips when the table already has rows (S16), reads the CSV with every column as text
(S4), checks the raw-row rules (R14), appends good rows and quarantines the rest with a
message and time (S15), and reports the row counts (S17).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import schemas as S
from ledgerline.operators.quality import validate
from ledgerline.sinks.files import path_exists, staged_rows
from ledgerline.sinks.load import load
from ledgerline.sources.files import CORRUPT, read_sales_csv_in_parallel

# fixed values: text length limits of the raw static table's columns
STATIC_LENGTHS = {
    "transaction_id": 16, "item": 20, "quantity": 10, "price_per_unit": 10,
    "total_spent": 10, "payment_method": 20, "location": 20, "transaction_date": 10,
}
CSV_TO_STATIC = dict(zip(S.SALES_CSV_COLUMNS, [
    "transaction_id", "item", "quantity", "price_per_unit", "total_spent",
    "location", "payment_method", "transaction_date"]))


def static_rules() -> list[tuple[Column, str]]:
    rules = [(F.col("transaction_id").isNull(), "Transaction ID is missing")]
    rules += [(F.length(c) > n, f"{c} is longer than {n}") for c, n in STATIC_LENGTHS.items()]
    return rules


def csv_to_static(raw: DataFrame) -> DataFrame:
    """CSV header names -> the static table's snake_case names (all text); the text of a
    malformed row stays beside them."""
    more = [CORRUPT] if CORRUPT in raw.columns else []
    return raw.select(*[F.col(f"`{src}`").alias(dst) for src, dst in CSV_TO_STATIC.items()], *more)


def split_malformed(static: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, malformed rows + error_message): a malformed row's fields cannot be
    trusted, so they are left empty and the message carries its text."""
    fields = S.TRANSACTIONS_STATIC.fieldNames()
    bad = static.where(F.col(CORRUPT).isNotNull()).select(
        *[F.lit(None).cast("string").alias(c) for c in fields],
        F.concat(F.lit("Malformed row: "), F.col(CORRUPT)).alias("error_message"))
    return static.where(F.col(CORRUPT).isNull()).select(*fields), bad


def validate_static_rows(static: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows + error_message) of the raw static table."""
    return validate(static.select(*S.TRANSACTIONS_STATIC.fieldNames()), static_rules())


def error_rows(rejected: DataFrame) -> DataFrame:
    """Rejected rows in the quarantine table's shape: an id per row, the raw fields, the message
    and the time (S15).

    The id is a hash of the row and of its number among equal rows, so it is the same on
    recompute and different for each row.  Equal rows are counted first, with partial
    aggregation, then written out again, so no task holds all copies of a row.
    """
    fields = S.TRANSACTIONS_STATIC.fieldNames()
    counted = rejected.groupBy(*fields, "error_message").agg(F.count(F.lit(1)).alias("__n"))
    each = counted.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__n"))))
    text = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")) for c in (*fields, "error_message")]
    seed = F.concat_ws("\u0001", *text, F.col("__copy").cast("string"))
    return each.select(
        F.conv(F.substring(F.sha2(seed, 256), 1, 15), 16, 10).cast("bigint").alias("id"),
        *fields, "error_message",
        F.current_timestamp().cast("timestamp_ntz").alias("created_at"))


def import_static_csv(spark: SparkSession, csv_path: str | list[str], static_path: str,
                      errors_path: str) -> DataFrame:
    """Returns a report (table_name, rows_written); zero rows when skipped.

    The rejected rows are written first, over those of an import that failed before its good
    rows were in; so good rows in the table mean that the rejects are there too.
    """
    if path_exists(spark, static_path) and not spark.read.parquet(static_path).isEmpty():
        return spark.createDataFrame([], "table_name string, rows_written bigint")
    # Parsed once and written aside, since both outputs read it.
    with staged_rows(spark, csv_to_static(read_sales_csv_in_parallel(spark, csv_path)), "csv-rows") as raw:
        whole, malformed = split_malformed(raw)
        good, rejected = validate_static_rows(whole)
        load(error_rows(rejected.unionByName(malformed)), errors_path, "replace")
        load(good, static_path, "append")
    return load_report(spark, {"transactions_static": static_path,
                               "transactions_errors": errors_path})


def load_report(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows per written table (S17), counted from the written files' metadata."""
    from functools import reduce
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows_written"))
             .select(F.lit(n).alias("table_name"), "rows_written") for n, p in paths.items()]
    return reduce(DataFrame.unionByName, parts)
