"""The hourly run kept up by deltas (M16, I7; S2, S9-S12, I1, I2, I5, A7, M1-M11).

``run_hourly`` rebuilds dimensions and transaction items from all of raw each hour.  Here every table is a
``VersionedTable``, and a step reads only what its sources have gained since the version that it read last.  That
version is part of the step's own commit, so a run that dies between two steps goes on where it stopped: each
step is repeatable, and none sees half of another's write.

====================== ==========================================================================================
lake/<table>           the OLTP snapshot, replaced in one commit
raw/<table>            rows past the stored cursor; the loaded rows are not read
models/stg_<table>     distinct rows, by month of the cursor: new rows are compared with the months they fall in
models/dim_<table>     the staging rows, appended
models/stg_transactions_static   merged past its mark; rows behind it that it lacks go to quarantine/late_static
models/dim_transaction_items     new lines + new sales x all items + old sales x new item names
models/fct_transactions          new versions of transactions merged into their dates
models/monthly_sales, item_quantity   roll-ups, recomputed for the months and items that changed
ledger                 one row per step and run: rows read, written, known, rejected; also of the step that failed
====================== ==========================================================================================
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable, Mapping, Sequence

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.scalar import to_date_safe
from ledgerline.operators.cursor_state import known_by_state, load_by_state
from ledgerline.operators.incremental import null_cursor_rows, quarantine_new
from ledgerline.operators.merge import _distinct_values
from ledgerline.operators.versioned_merge import merge_versioned
from ledgerline.plans import analytics, marts, staging
from ledgerline.plans.hourly import CURSORS, DATE_CURSORS, MONTH
from ledgerline.plans.imports import error_rows
from ledgerline.sinks.cache import ResultCache
from ledgerline.sinks.files import staged_rows
from ledgerline.sinks.versioned import VersionedTable

SLICE = "slice"
ORIGIN = "origin"
LIVE, STATIC, UNMATCHED = "live", "static", "unmatched"
KEEP_VERSIONS = 3   # of each table, for readers that hold one
MOST_SLICES = 32    # small ones in one partition
MODELS = ("dim_customers", "dim_items", "dim_payment_methods", "stg_transactions_static", "dim_transaction_items",
          "fct_transactions", "monthly_sales", "item_quantity")
LEDGER_COUNTS = ("rows_read", "rows_written", "rows_known", "rows_rejected")
LEDGER = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("step", T.StringType()),
                       T.StructField("place", T.IntegerType()), T.StructField("status", T.StringType()),
                       *[T.StructField(c, T.LongType()) for c in LEDGER_COUNTS],
                       T.StructField("error", T.StringType())])


@dataclass
class Store:
    """Where the tables of one warehouse lie."""
    spark: SparkSession
    root: str
    by_month: bool = False

    def _table(self, kind: str, name: str, part: str | None = None) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root.rstrip('/')}/{kind}/{name}", part)

    def lake(self, name: str) -> VersionedTable:
        return self._table("lake", name)

    def raw(self, name: str) -> VersionedTable:
        return self._table("raw", name)

    def staging(self, name: str) -> VersionedTable:
        return self._table("models", f"stg_{name}", SLICE)

    def model(self, name: str) -> VersionedTable:
        part = {"dim_transaction_items": ORIGIN, "fct_transactions": self.date_part,
                "stg_transactions_static": self.date_part}.get(name)
        return self._table("models", name, part)

    @property
    def date_part(self) -> str:
        return MONTH if self.by_month else "transaction_date"

    def ledger(self) -> VersionedTable:
        return self._table("run", "ledger")

    def quarantine(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/quarantine/{name}"

    def parted(self, df: DataFrame) -> DataFrame:
        return df.withColumn(MONTH, F.trunc("transaction_date", "MM")) if self.by_month else df

    def facts(self) -> DataFrame:
        return self.model("fct_transactions").read().select(*marts.FCT_COLUMNS)

    def transaction_items(self) -> DataFrame:
        return self.model("dim_transaction_items").read().select(*marts.TI_COLUMNS)

    def monthly_sales(self) -> DataFrame:
        """The dashboard's monthly figures, from the roll-up."""
        return self.model("monthly_sales").read().select("month", "order_count", "total_sales").orderBy("month")

    def item_quantity(self) -> DataFrame:
        """The dashboard's quantity per item, from the roll-up and the item dimension."""
        per_id = self.model("item_quantity").read().groupBy("item_id").agg(F.sum("quantity").alias("__qty"))
        return analytics._by_name(per_id, self.model("dim_items").read())


def dashboard(store: Store, cache: ResultCache) -> dict[str, DataFrame]:
    """The dashboard's three results over the built tables, kept until an hour is over or a run has changed the table."""
    def kept(name: str, table: str, build: Callable[[], DataFrame]) -> DataFrame:
        return cache.get(f"{store.root}/{name}", build, store.model(table).manifest().version)

    items = (store.model("item_quantity").manifest().version, store.model("dim_items").manifest().version)
    return {"monthly_sales": kept("monthly_sales", "monthly_sales", store.monthly_sales),
            "item_quantity": cache.get(f"{store.root}/item_quantity", store.item_quantity, items),
            "explore": kept("explore", "fct_transactions", lambda: analytics.explore(store.facts()))}


@dataclass
class Counts:
    """What a step did; read = written + known + rejected wherever a step takes or leaves single rows."""
    read: int | None = None
    written: int | None = None
    known: int | None = None
    rejected: int | None = None


@dataclass
class IncrementalReport:
    run_id: str
    steps: dict = field(default_factory=dict)   # step -> Counts


def _gained(source: VersionedTable, version: int | None, folder: str | None = None) -> DataFrame | None:
    """Rows that ``source`` gained since ``version``; None where it must be read whole."""
    return None if version is None else source.added_since(version, folder)


def load(store: Store, name: str, before_commit=None) -> Counts:
    """Lake to raw by stored cursor.  Rows without a cursor go to the load quarantine."""
    cursor, keys = CURSORS[name]
    src = store.lake(name).read()
    parsed = to_date_safe(cursor) if name in DATE_CURSORS else None
    lost = null_cursor_rows(src, cursor, keys, name, parsed)
    rejected = lost.count()
    if rejected:
        quarantine_new(store.spark, lost, store.quarantine(f"load/{name}"))
    known = known_by_state(store.raw(name), src, cursor, keys, parsed)
    n = load_by_state(store.raw(name), src, cursor, keys, parsed, before_commit=before_commit)
    return Counts(src.count(), n, known, rejected)  # counted each by itself; the first from the files' footers


def _slice(name: str) -> Column:
    return F.trunc(F.to_date(CURSORS[name][0]), "MM")


def stage_delta(store: Store, name: str) -> DataFrame | None:
    """The rows of raw that staging lacks, or None if staging must be built anew.

    Equal rows have equal cursors, so a new row can repeat only rows of its own month: of staging, the months that the new
    rows fall in are read and no others.  New rows and old ones are grouped together, in one shuffle.
    """
    raw, stg = store.raw(name), store.staging(name)
    new = _gained(raw, stg.state().get("raw"))
    if new is None:
        return None
    rows = new.select(*staging.STAGING_COLUMNS[name]).withColumn(SLICE, _slice(name))
    both = rows.withColumn("__old", F.lit(False)).unionByName(
        stg.read(_distinct_values(rows, SLICE)).select(*rows.columns).withColumn("__old", F.lit(True)))
    return both.groupBy(*rows.columns).agg(F.max("__old").alias("__old")).where("not __old").drop("__old")


def stage(store: Store, name: str) -> Counts:
    """Distinct raw rows (M1-M5, A7), kept up month by month of the cursor."""
    raw, stg = store.raw(name), store.staging(name)
    version = raw.manifest().version
    if stg.state().get("raw") == version:
        return Counts(0, 0, 0, 0)
    delta = stage_delta(store, name)
    count = {"n": F.count(F.lit(1))}
    seen: dict = {}

    def state(observed, _written) -> dict:
        seen.update(observed)
        return {"raw": version}

    if delta is None:
        read = raw.read().count()
        stg.replace(staging.stage(raw.read(), name).withColumn(SLICE, _slice(name)), observe=count, state=state)
    else:
        read = raw.added_since(stg.state()["raw"]).count()
        stg.append(delta, observe=count, state=state)
    return Counts(read, seen["n"], read - seen["n"], 0)


def dimension(store: Store, name: str) -> Counts:
    """A pass-through dimension: the staging rows as a table, new ones appended."""
    stg, dim = store.staging(name), store.model(f"dim_{name}")
    version = stg.manifest().version
    if dim.state().get("stg") == version:
        return Counts(0, 0, 0, 0)
    new = _gained(stg, dim.state().get("stg"))
    write, rows = (dim.replace, stg.read()) if new is None else (dim.append, new)
    seen: dict = {}
    write(rows.drop(SLICE), observe={"n": F.count(F.lit(1))}, state=lambda observed, _: seen.update(observed) or {"stg": version})
    return Counts(seen["n"], seen["n"], 0, 0)


def static_mark(static: VersionedTable):
    """The latest date of the static model, from its last partition alone; None for an empty one."""
    m = static.manifest()
    if m is None:
        return None
    dated = sorted(f for f in m.folders() if not f.endswith("__HIVE_DEFAULT_PARTITION__"))
    if not dated:
        return None
    last = [s for s in m.slices if s.folder == dated[-1]]
    return static.rows_of(last, m.schema).agg(F.max("transaction_date")).first()[0]


FATES = ("incomplete", "rejected", "late", "known", "new")


def seed_fates(store: Store, seed: DataFrame, rejected: str | None = None) -> DataFrame:
    """The seed's rows typed, with what the next run does with each as ``fate``; together they are the seed.

    A good row is ``new`` past the mark, ``known`` where the static model has its key, and ``late`` otherwise: the mark
    would keep it out of every later run.  Of the static model the key column is read.  ``rejected`` is as in
    ``staging.with_fates``.
    """
    static = store.model("stg_transactions_static")
    mark, rows = static_mark(static), staging.with_fates(seed, rejected)
    good = F.lit("new")
    if mark is not None:
        have = static.read().select(F.col("transaction_id").alias("__id")).distinct()
        rows = rows.join(have, rows["transaction_id"] == have["__id"], "left")
        good = F.when(F.col("transaction_date") > F.lit(mark), "new").when(F.col("__id").isNotNull(), "known").otherwise("late")
    fate = F.when(F.col("fate") == "good", good).otherwise(F.col("fate")).alias("fate")
    return rows.select(*staging.STATIC_COLUMNS, fate, *([rejected] if rejected else []))


def static_fates(store: Store, seed: DataFrame) -> DataFrame:
    """How many rows of the seed have each fate (fate, row_count)."""
    return seed_fates(store, seed).groupBy("fate").agg(F.count(F.lit(1)).alias("row_count"))


def _late_rows(rows: DataFrame) -> DataFrame:
    return rows.select(F.lit("transactions_static").alias("table_name"), F.col("transaction_id").alias("row_key"),
                       F.lit("transaction_date is not after those loaded before").alias("error_message"),
                       F.to_json(F.struct(*rows.columns)).alias("payload"))


def static_model(store: Store, seed: DataFrame) -> Counts:
    """M6 past its mark; late rows go to the quarantine, as do those that don't parse.  The seed is read once."""
    with staged_rows(store.spark, seed_fates(store, seed, "rejected"), "seed-fates") as rows:
        error_rows(staging.rejected_of(rows, "rejected")).write.mode("overwrite").parquet(store.quarantine("static"))
        rows = rows.drop("rejected")
        n = {r["fate"]: r["count"] for r in rows.groupBy("fate").count().collect()}  # five rows at most
        if n.get("late"):
            quarantine_new(store.spark, _late_rows(rows.where("fate = 'late'").drop("fate")), store.quarantine("late_static"))
        new = rows.where("fate = 'new'").drop("fate").distinct()
        if n.get("new") or not store.model("stg_transactions_static").exists():
            merge_versioned(store.model("stg_transactions_static"), store.parted(new), "transaction_id")
    return Counts(sum(n.values()), n.get("new", 0), n.get("known", 0), sum(n.get(k, 0) for k in FATES[:3]))


def transaction_items(store: Store) -> Counts:
    """M8 by its delta, in one commit.

    Live lines and sales that found their item are only ever added.  Sales whose name no item has stand in a partition of
    their own, with the name, so that those whose item comes later can leave it.
    """
    table = store.model("dim_transaction_items")
    sources = {"lines": store.staging("transaction_items"), "sales": store.model("stg_transactions_static"),
               "items": store.staging("items")}
    now = {k: t.manifest().version for k, t in sources.items()}
    then = table.state()
    if all(then.get(k) == v for k, v in now.items()):
        return Counts(0, 0, 0, 0)
    gained = {k: _gained(t, then.get(k)) for k, t in sources.items()}

    def live(lines: DataFrame) -> DataFrame:
        return lines.select(*marts.TI_COLUMNS, F.lit(None).cast("string").alias("unmatched_name"), F.lit(LIVE).alias(ORIGIN))

    def matched(sales: DataFrame, items: DataFrame) -> DataFrame:
        """The sales with their items, and those whose name no item has, from one join."""
        found = F.col("__found")
        return marts.static_items(sales, items, found="__found").select(
            *marts.TI_COLUMNS, F.when(~found, F.col("item_name")).alias("unmatched_name"),
            F.when(found, STATIC).otherwise(UNMATCHED).alias(ORIGIN))

    items, written = sources["items"].read(), {}

    def state(observed, _rows) -> dict:
        written.update(observed)
        return now

    # Three partitions, two of them large: what a task has goes to a file of its own.
    options = {"observe": {"n": F.count(F.lit(1))}, "state": state, "rebalance": False}
    if any(d is None for d in gained.values()):
        sales = sources["sales"].read()
        table.replace(live(sources["lines"].read()).unionByName(matched(sales, items)), **options)
    else:
        old_sales = sources["sales"].read(version=then["sales"])
        new_names = gained["items"].select(F.col("name").alias("__n")).distinct()
        waiting = table.read([UNMATCHED])
        waiting = waiting.join(new_names, waiting["unmatched_name"] == F.col("__n"), "left_anti")
        table.replace_folders(live(gained["lines"]).unionByName(matched(gained["sales"], items))
                              .unionByName(matched(old_sales, gained["items"]).where(F.col(ORIGIN) == STATIC))
                              .unionByName(waiting), [UNMATCHED], **options)
    return Counts(None, written["n"])


def fact(store: Store) -> Counts:
    """M9: new versions of live transactions and new static sales, merged into their dates."""
    fct, live, static = store.model("fct_transactions"), store.staging("transactions"), store.model("stg_transactions_static")
    pm = store.model("dim_payment_methods").read()
    now = {"live": live.manifest().version, "sales": static.manifest().version}
    then = fct.state()
    if all(then.get(k) == v for k, v in now.items()):
        return Counts(0, 0, 0, 0)
    new_live, new_static = _gained(live, then.get("live")), _gained(static, then.get("sales"))
    # What can't be told apart by version is merged whole: rows that the fact has already change nothing.
    src = (marts.live_facts(live.read() if new_live is None else new_live, pm)
           .unionByName(marts.static_facts(static.read() if new_static is None else new_static)))
    # Of several versions of one transaction in one run the newest counts; static sales have no times.
    merge_versioned(fct, store.parted(src.select(*marts.FCT_COLUMNS)), "transaction_id", on_duplicate="latest",
                    order_cols=["updated_at", "created_at", "transaction_date"], state=now)
    return Counts()


def monthly_rollup(store: Store) -> Counts:
    """M11 per month; only the months whose partitions of the fact changed are read again."""
    fct, table = store.model("fct_transactions"), store.model("monthly_sales")
    version = fct.manifest().version
    if table.state().get("fct") == version:
        return Counts(0, 0, 0, 0)
    changed = fct.changed_since(table.state()["fct"]) if table.exists() else None
    if changed is None:
        out = analytics.monthly_sales(fct.read())
        table.replace(out.coalesce(1), state={"fct": version})
        return Counts()
    months = {f.split("=", 1)[1][:7] for f in changed}
    m = fct.manifest(version)
    again = analytics.monthly_sales(fct.rows_of([s for s in m.slices if s.folder.split("=", 1)[1][:7] in months], m.schema))
    stay = table.read().where(~F.coalesce(F.date_format("month", "yyyy-MM"), F.lit("__HIVE_")).isin(sorted(months)))
    out = stay.unionByName(again)
    table.replace(out.coalesce(1), state={"fct": version})  # a row for each month
    return Counts()


def quantity_rollup(store: Store) -> Counts:
    """M10 per origin and item id: what the transaction items gained is added; a partition that lost rows is summed anew."""
    ti, table = store.model("dim_transaction_items"), store.model("item_quantity")
    version = ti.manifest().version
    then = table.state().get("items")
    if then == version:
        return Counts(0, 0, 0, 0)
    parts = []
    for origin in (LIVE, STATIC, UNMATCHED):
        new = _gained(ti, then, f"{ORIGIN}={origin}")
        if new is None:
            parts.append(ti.read([origin]))
        else:
            parts.append(new)
            parts.append(table.read().where(F.col(ORIGIN) == origin))
    sums = parts[0].select(ORIGIN, "item_id", "quantity")
    for p in parts[1:]:
        sums = sums.unionByName(p.select(ORIGIN, "item_id", "quantity"))
    table.replace(sums.groupBy(ORIGIN, "item_id").agg(F.sum("quantity").alias("quantity")), state={"items": version})
    return Counts()


Step = tuple[str, Callable[[], Counts], tuple]


def phases(store: Store, oltp: Mapping[str, DataFrame], seed: DataFrame) -> list[list[list[Step]]]:
    """The steps (name, step, tags): phases one after the other, in each of them lanes that don't depend on one another."""
    def snapshot(name: str) -> Counts:
        n: dict = {}
        store.lake(name).replace(oltp[name], observe={"n": F.count(F.lit(1))}, state=lambda seen, _: n.update(seen) or {})
        return Counts(n["n"], n["n"], 0, 0)

    def lane(name: str) -> list[Step]:
        out = [(f"extract_{name}", lambda: snapshot(name), ()), (f"load_{name}", lambda: load(store, name), ())]
        if name in staging.STAGING_COLUMNS:
            out.append((f"stg_{name}", lambda: stage(store, name), ()))
        if name in ("customers", "items", "payment_methods"):
            out.append((f"dim_{name}", lambda: dimension(store, name), ()))
        return out

    static = ("stg_transactions_static", lambda: static_model(store, seed), ("static",))
    return [[lane(t) for t in CURSORS if t in oltp] + [[static]],
            [[("dim_transaction_items", lambda: transaction_items(store), ()),
              ("item_quantity", lambda: quantity_rollup(store), ())],
             [("fct_transactions", lambda: fact(store), ()), ("monthly_sales", lambda: monthly_rollup(store), ())]]]


def run_incremental(spark: SparkSession, oltp: Mapping[str, DataFrame], seed: DataFrame, root: str,
                    exclude_tags: Sequence[str] = ("static",), by_month: bool = False,
                    lanes_at_once: int = 4) -> IncrementalReport:
    """One run over the warehouse at ``root``.

    Lanes of a phase run side by side, since their tables have nothing to do with each other.  A step that fails ends its
    lane, and the run after the other lanes of its phase; its row in the ledger says so.
    """
    store = Store(spark, root, by_month)
    report = IncrementalReport(uuid.uuid4().hex[:12])
    rows = []

    def run_lane(lane: list[Step]) -> None:
        for name, step, tags in lane:
            if set(tags) & set(exclude_tags):
                continue
            try:
                c = step()
            except Exception as e:
                rows.append((report.run_id, name, len(rows), "failed", None, None, None, None, f"{type(e).__name__}: {e}"[:500]))
                raise
            report.steps[name] = c
            rows.append((report.run_id, name, len(rows), "done", c.read, c.written, c.known, c.rejected, None))

    try:
        for phase in phases(store, oltp, seed):  # fixed lists of steps, not data
            with ThreadPoolExecutor(lanes_at_once) as pool:
                done = [pool.submit(inheritable_thread_target(spark)(run_lane), lane) for lane in phase]
            for f in done:
                f.result()
    finally:
        store.ledger().append(spark.createDataFrame(rows, LEDGER).coalesce(1))
    tidy(store, list(oltp))
    return report


def tidy(store: Store, names: Sequence[str], keep: int = KEEP_VERSIONS, most_slices: int = MOST_SLICES) -> None:
    """Merge small files and delete old versions, after a run that went through: every step has read its sources up to
    their latest version by then, so neither takes away what a later delta needs.  At least two versions stay: the one that
    was read and the one that compaction made of it."""
    if keep < 2:
        raise ValueError("later deltas start from the last version but one")
    tables = [store.ledger()]
    for t in names:
        tables += [store.lake(t), store.raw(t)] + ([store.staging(t)] if t in staging.STAGING_COLUMNS else [])
    tables += [store.model(m) for m in MODELS]
    for t in tables:
        if t.exists():
            t.compact(most_slices)
            t.vacuum(keep)


def run_ledger(store: Store) -> DataFrame:
    """The steps of all runs, and whether a step's rows add up (NULL where it doesn't count single rows)."""
    total = F.col("rows_written") + F.col("rows_known") + F.col("rows_rejected")
    return store.ledger().read().withColumn("adds_up", F.col("rows_read") == total)
