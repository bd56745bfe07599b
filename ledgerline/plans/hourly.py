"""The hourly batch (M16, I7, F7, S17): extract -> load -> transform, as one Spark app.

* extract: snapshot each OLTP table to the lake as Parquet, replacing the last one (S2);
* load: append to the raw tables only rows past each table's cursor (I1, I3); the first
  run loads everything.  On every run rows without a cursor go to the load quarantine;
* transform: staging models as temporary views (S10); dimensions and transaction items
  rebuilt as tables (S9); the static model and the fact merged incrementally by key into
  date-partitioned tables (S11, S12, I5) with their high-water marks (F2, F3).

Steps carry tags; ``exclude_tags=("static",)`` leaves out the static model, which must
then exist from a first run, as in the source schedule.  Scheduling and retries belong to
whatever runs the app.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.scalar import to_date_safe
from ledgerline.operators.incremental import (high_water_value, incremental_load, newer_than,
                                              null_cursor_rows, quarantine_new)
from ledgerline.operators.merge import merge_upsert, replace_table
from ledgerline.plans import marts, staging
from ledgerline.plans.imports import error_rows
from ledgerline.sinks.files import path_exists, staged_rows
from ledgerline.sinks.load import snapshot

# fixed values: cursor column and primary key of each raw table (load hints of the source)
CURSORS = {
    "items": ("updated_at", ["item_id"]),
    "transactions": ("updated_at", ["transaction_id"]),
    "transaction_items": ("created_at", ["transaction_id", "item_id"]),
    "customers": ("updated_at", ["customer_id"]),
    "payment_methods": ("created_at", ["payment_method_id"]),
    "transactions_static": ("transaction_date", ["transaction_id"]),
}
# Cursors that the raw table keeps as text: compared as dates, since as text a word such as
# UNKNOWN would sort above every date and stop the load for good.
DATE_CURSORS = {"transactions_static"}


MONTH = "sale_month"


@dataclass
class Warehouse:
    root: str

    def lake(self, table: str) -> str:
        return f"{self.root}/lake/{table}"

    def raw(self, table: str) -> str:
        return f"{self.root}/raw/{table}"

    def model(self, name: str) -> str:
        return f"{self.root}/models/{name}"

    def quarantine(self, name: str) -> str:
        return f"{self.root}/quarantine/{name}"


@dataclass
class Step:
    name: str
    run: Callable[[], DataFrame | None]
    tags: tuple = ()


@dataclass
class RunReport:
    loaded: dict = field(default_factory=dict)   # raw table -> rows appended
    models: list = field(default_factory=list)   # model names built


def extract(oltp: Mapping[str, DataFrame], wh: Warehouse) -> None:
    for name, df in oltp.items():
        snapshot(df, wh.lake(name))


def load_raw(spark: SparkSession, wh: Warehouse, tables: Sequence[str] = tuple(CURSORS)) -> dict:
    """Append new rows of each lake snapshot to its raw table; returns rows appended.
    The count is observed during the write itself, with no second scan (S17).  Rows whose
    cursor is missing can't be placed, on the first run or later: they go to the load quarantine."""
    out = {}
    for t in tables:
        cursor, keys = CURSORS[t]
        src = spark.read.parquet(wh.lake(t))
        parsed = to_date_safe(cursor) if t in DATE_CURSORS else F.col(cursor)
        quarantine_new(spark, null_cursor_rows(src, cursor, keys, t,
                                               parsed if t in DATE_CURSORS else None),
                       wh.quarantine("load"))
        new = src.withColumn("__cursor", parsed).where(F.col("__cursor").isNotNull())
        if path_exists(spark, wh.raw(t)):
            have = spark.read.parquet(wh.raw(t)).withColumn("__cursor", parsed)
            new = incremental_load(new, have, "__cursor", keys)
        obs = Observation(f"load_{t}")
        (new.drop("__cursor").observe(obs, F.count(F.lit(1)).alias("rows"))
            .write.mode("append").parquet(wh.raw(t)))
        out[t] = obs.get["rows"]
    return out


def live_mark(fct: DataFrame, scope: str = "live"):
    """The fact's high-water mark, as a value so the filter reaches the scan.  ``live`` (default) takes it over live rows only, so a
    static sale dated in the future cannot block new sales; ``all`` is the source model's
    mark over every row."""
    if scope == "live":
        fct = fct.where(F.col("created_at").isNotNull())
    elif scope != "all":
        raise ValueError("scope is 'live' or 'all'")
    return high_water_value(fct, "transaction_date")


def transform(spark: SparkSession, wh: Warehouse, seed: DataFrame,
              exclude_tags: Sequence[str] = (), full_refresh: bool = False,
              mark_scope: str = "live", by_month: bool = False) -> list[str]:
    """``by_month`` partitions the static model and the fact by month instead of by day."""
    raw = {t: spark.read.parquet(wh.raw(t)) for t in staging.STAGING_COLUMNS}
    part = MONTH if by_month else "transaction_date"

    def parted(df: DataFrame) -> DataFrame:
        return df.withColumn(MONTH, F.trunc("transaction_date", "MM")) if by_month else df

    def merge(path: str, src: DataFrame, **options) -> None:
        merge_upsert(spark, path, parted(src), "transaction_id", part, **options)

    stg = {
        "stg_customers": staging.stg_customers(raw["customers"]),
        "stg_items": staging.stg_items(raw["items"]),
        "stg_payment_methods": staging.stg_payment_methods(raw["payment_methods"]),
        "stg_transactions": staging.stg_transactions(raw["transactions"]),
        "stg_transaction_items": staging.stg_transaction_items(raw["transaction_items"]),
    }
    static_path = wh.model("stg_transactions_static")
    fct_path = wh.model("fct_transactions")

    def view(name: str) -> Callable[[], DataFrame]:
        def run():
            stg[name].createOrReplaceTempView(name)
            return None
        return run

    def table(name: str, build: Callable[[], DataFrame]) -> Callable[[], None]:
        def run():
            build().write.mode("overwrite").parquet(wh.model(name))
        return run

    def static_model():
        # The seed is read and typed once; what is good and what is rejected is then told from the staged rows.
        complete = staging.with_fates(seed, "rejected").where("fate != 'incomplete'")
        with staged_rows(spark, complete, "seed-fates") as rows:
            error_rows(staging.rejected_of(rows, "rejected")).write.mode("overwrite") \
                .parquet(wh.quarantine("static"))
            good = rows.where("fate = 'good'").select(*staging.STATIC_COLUMNS)
            if full_refresh:
                replace_table(spark, static_path, parted(good.distinct()), "transaction_id", part)
                return
            mark = high_water_value(spark.read.parquet(static_path), "transaction_date") \
                if path_exists(spark, static_path) else None
            merge(static_path, newer_than(good, "transaction_date", mark).distinct(), on_duplicate="raise")

    def static_table() -> DataFrame:
        return spark.read.parquet(static_path).select(*staging.STATIC_COLUMNS)

    def fact():
        pm = spark.read.parquet(wh.model("dim_payment_methods"))
        live = stg["stg_transactions"]
        if full_refresh or not path_exists(spark, fct_path):
            replace_table(spark, fct_path, parted(marts.fct_transactions(live, static_table(), pm)),
                          "transaction_id", part)
            return
        fct = spark.read.parquet(fct_path)
        # Live rows keep their date (created_at does not change): no scan of the fact's keys.
        merge(fct_path, marts.live_facts(live, pm, live_mark(fct, mark_scope))
              .select(*marts.FCT_COLUMNS), keys_may_move=False)
        # Static rows come in past the static model's own strict mark, so only those from the
        # fact's latest static date on can be new.
        static_mark = high_water_value(fct.where(F.col("created_at").isNull()), "transaction_date")
        merge(fct_path, marts.static_facts(newer_than(static_table(), "transaction_date",
                                                      static_mark, inclusive=True))
              .select(*marts.FCT_COLUMNS))

    steps = [Step(n, view(n)) for n in stg] + [
        Step("stg_transactions_static", static_model, ("static",)),
        Step("dim_customers", table("dim_customers", lambda: marts.dim_customers(stg["stg_customers"]))),
        Step("dim_items", table("dim_items", lambda: marts.dim_items(stg["stg_items"]))),
        Step("dim_payment_methods", table("dim_payment_methods",
                                          lambda: marts.dim_payment_methods(stg["stg_payment_methods"]))),
        Step("dim_transaction_items", table("dim_transaction_items", lambda: marts.dim_transaction_items(
            stg["stg_transaction_items"], static_table(), stg["stg_items"]))),
        Step("fct_transactions", fact),
    ]
    done = []
    for step in steps:  # a fixed list of model steps, not data
        if set(step.tags) & set(exclude_tags):
            continue
        step.run()
        done.append(step.name)
    return done


def run_hourly(spark: SparkSession, oltp: Mapping[str, DataFrame], seed: DataFrame,
               root: str, exclude_tags: Sequence[str] = ("static",),
               full_refresh: bool = False, mark_scope: str = "live",
               by_month: bool = False) -> RunReport:
    wh = Warehouse(root.rstrip("/"))
    extract(oltp, wh)
    loaded = load_raw(spark, wh, [t for t in CURSORS if t in oltp])
    models = transform(spark, wh, seed, exclude_tags, full_refresh, mark_scope, by_month)
    return RunReport(loaded, models)


def loaded_rows(spark: SparkSession, report: RunReport) -> DataFrame:
    """Rows that the run appended per raw table."""
    return spark.createDataFrame(list(report.loaded.items()), "table_name string, rows_appended bigint")


def model_counts(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """Rows per model table (S17), one small union of counts."""
    wh = Warehouse(root.rstrip("/"))
    parts = [spark.read.parquet(wh.model(n)).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(n).alias("model"), "row_count") for n in names]
    return reduce(DataFrame.unionByName, parts)
