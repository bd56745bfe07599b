"""Batch ingest of sale requests and reference data.

The source service handles one request at a time inside a database transaction.  Here a
whole batch is one set of DataFrame jobs:

1. flatten: one row per request (header) and one row per item line; nested requests
   are exploded (a narrow step), so no step ever gathers a request's items together;
2. normalise email and item names, look up the payment method (exact name) and the
   latest item row per name (J5, J6);
3. line problems and the line total are rolled up per request with a grouped aggregate
   (partial aggregation, so a request with millions of lines is still pre-reduced in
   every task);
4. one message column per request decides good or rejected (R0–R9); a request with any
   bad line is rejected whole (R15) by a semi join of its lines on the good requests;
5. good lines are priced (subtotal = latest price × quantity); a good request's total is
   the rolled-up sum of its lines (A8); new customers are the distinct unknown emails of good requests (J4).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.scalar import (email_local_part, is_blank, short_id,
                                         strip, strip_lower, today_text)
from ledgerline.operators.latest import latest_by
from ledgerline.operators.quality import validate

# fixed values: accepted locations and field length limits of the request model
LOCATIONS = ("In-store", "Takeaway")
EMAIL_MAX, ITEM_NAME_MAX, PAYMENT_MAX, LOCATION_MAX = 100, 100, 50, 255
ID_HEX_DIGITS = 16


@dataclass
class IngestResult:
    transactions: DataFrame
    transaction_items: DataFrame
    new_customers: DataFrame
    errors: DataFrame
    good_requests: DataFrame
    error_items: DataFrame
    cached: list = field(default_factory=list)

    def release(self) -> None:
        for df in self.cached:
            df.unpersist()
        self.cached = []


def flatten_requests(requests: DataFrame, id_col: str = "request_id") -> tuple[DataFrame, DataFrame]:
    """Nested requests -> (headers, lines).  ``posexplode_outer`` keeps a request with an
    empty or NULL item list as one line of NULLs, so rule R2 can still see it."""
    headers = requests.drop("items")
    lines = (requests.select(id_col, F.posexplode_outer("items").alias("line_no", "item"))
             .select(id_col, "line_no", F.col("item.item_name").alias("item_name"),
                     F.col("item.quantity").alias("quantity"))
             .where(F.col("line_no").isNotNull()))
    return headers, lines


def normalise_headers(headers: DataFrame) -> DataFrame:
    """Strip + lower the email (blank check on the raw value)."""
    return headers.withColumn("email_norm", strip_lower("customer_email"))


def latest_items(items: DataFrame) -> DataFrame:
    """Newest row per item name; ties go to the larger item_id."""
    return latest_by(items, ["name"], ["updated_at", "item_id"])


def price_lines(lines: DataFrame, items: DataFrame) -> DataFrame:
    """Lines with the stripped name, the latest item id and price, and line flags."""
    it = latest_items(items).select(F.col("name").alias("__iname"),
                                    F.col("item_id").alias("item_id"),
                                    F.col("unit_price").alias("unit_price"))
    ln = lines.withColumn("name_norm", strip("item_name"))
    j = ln.join(it, ln["name_norm"] == it["__iname"], "left").drop("__iname")
    return (j.withColumn("bad_name", F.col("item_name").isNull() | is_blank("item_name") |
                         (F.length("item_name") > ITEM_NAME_MAX))
             .withColumn("bad_qty", F.col("quantity").isNull() | (F.col("quantity") <= 0))
             .withColumn("no_item", F.col("item_id").isNull() &
                         ~(F.col("item_name").isNull() | is_blank("item_name"))))


def line_summary(priced: DataFrame, id_col: str = "request_id") -> DataFrame:
    """Per request: line count, names, distinct names, any bad line, and the sum of the
    line amounts.

    Two grouped aggregates, both partially aggregated before their shuffle: per (request,
    name), then per request.  This gives count(DISTINCT name) without the row-doubling
    Expand that Spark plans for a distinct aggregate next to other aggregates.  Every
    line of a good request is good, so ``lines_total`` is a good request's total and the
    lines need no second pass.  It is summed as decimal, exact whatever the grouping or
    the order rows arrive in, so a retried task gives the same value.
    """
    amount = (F.col("unit_price") * F.col("quantity")).cast("decimal(38,9)")
    per_name = priced.groupBy(id_col, "name_norm").agg(
        F.count(F.lit(1)).alias("__n"),
        F.max(F.col("bad_name").cast("int")).alias("__bad_name"),
        F.max(F.col("bad_qty").cast("int")).alias("__bad_qty"),
        F.max(F.col("no_item").cast("int")).alias("__no_item"),
        F.sum(amount).alias("__amount"))
    named = F.col("name_norm").isNotNull()
    return per_name.groupBy(id_col).agg(
        F.sum("__n").alias("n_lines"),
        F.sum(F.when(named, F.col("__n")).otherwise(F.lit(0))).alias("n_names"),
        F.count("name_norm").alias("n_distinct_names"),
        F.max("__bad_name").alias("any_bad_name"),
        F.max("__bad_qty").alias("any_bad_qty"),
        F.max("__no_item").alias("any_no_item"),
        F.sum("__amount").alias("lines_total"),
    )


def request_rules() -> list[tuple[Column, str]]:
    """(failure condition, message) per rule, in the order messages are joined.  fixed values:
    the texts of the messages."""
    email = F.col("customer_email")
    return [
        (email.isNull() | is_blank(email), "Customer email cannot be empty"),
        (F.length(email) > EMAIL_MAX, f"Customer email is longer than {EMAIL_MAX}"),
        (F.coalesce(F.col("n_lines"), F.lit(0)) < 1, "At least one item is required"),
        (F.col("any_bad_name") == 1, "Item name cannot be empty or longer than 100"),
        (F.col("any_bad_qty") == 1, "Quantity must be greater than 0"),
        (F.col("n_names") != F.col("n_distinct_names"),
         "Duplicate items are not allowed in the same transaction"),
        (F.length("payment_method") > PAYMENT_MAX, f"Payment method is longer than {PAYMENT_MAX}"),
        (F.col("location").isNull() | ~F.col("location").isin(*LOCATIONS) |
         (F.length("location") > LOCATION_MAX),
         'Location must be either "In-store" or "Takeaway"'),
        (F.col("payment_method_id").isNull(), "Payment method not found"),
        (F.col("any_no_item") == 1, "Item not found"),
    ]


def lookup_payment(headers: DataFrame, payment_methods: DataFrame) -> DataFrame:
    """Exact-name lookup; one row per name (the newest) so the join cannot fan out.
    ``is_active`` is not tested, as in the source service."""
    pm = latest_by(payment_methods, ["name"], ["created_at", "payment_method_id"]).select(
        F.col("name").alias("__pm_name"), "payment_method_id")
    return headers.join(pm, headers["payment_method"] == pm["__pm_name"], "left").drop("__pm_name")


def validate_requests(headers: DataFrame, lines: DataFrame, items: DataFrame,
                      payment_methods: DataFrame, id_col: str = "request_id",
                      persist: bool = False):
    """Return (good headers, good priced lines with the request's ``created_at``, rejected
    headers with ``error_message``).

    With ``persist`` the two shared parents (headers with their lookups and line
    roll-up, and the priced lines) are kept in executor storage, so the outputs derived
    from them do not each recompute the validation; they are returned as a fourth item
    for the caller to release."""
    priced = price_lines(lines, items)
    summary = line_summary(priced, id_col)
    h = lookup_payment(normalise_headers(headers), payment_methods).join(summary, id_col, "left")
    cached = []
    if persist:
        from pyspark import StorageLevel
        h, priced = [d.persist(StorageLevel.MEMORY_AND_DISK) for d in (h, priced)]
        cached = [h, priced]
    good, rejected = validate(h, request_rules())
    # One inner join keeps the lines of good requests and brings the request's time.
    good_lines = priced.join(good.select(id_col, "created_at"), id_col)
    if persist:
        return good, good_lines, rejected, cached
    return good, good_lines, rejected


ID_BITS = 60


def hashed_id(key: Column, bits: int = ID_BITS) -> Column:
    """The first ``bits`` (60 at most) of the key's MD5: the same on every run, with no global counter."""
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint").bitwiseAND(F.lit((1 << bits) - 1))


def with_unique_ids(rows: DataFrame, id_col: str, key: Column, taken: DataFrame,
                    bits: int = ID_BITS) -> DataFrame:
    """``rows`` with an id for those whose ``id_col`` is NULL, unlike all others in ``rows`` and in ``taken``.

    The id is the key's hash plus a multiple of 2^bits: 0 for the first holder of a hash, and one more for each key
    after it, in order of the keys, past the largest that ``taken`` or a given id of ``rows`` has there.  So ids are the
    hashes wherever those don't clash, and the same again when the batch is run again.  ``taken`` has ``id_col``;
    ids of another origin in it count as well.  Keys must differ.  The clashing keys of one hash meet in one task; others don't.
    """
    mask, top = (1 << bits) - 1, (1 << (63 - bits)) - 1
    given = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("__id"))
    held = taken.select(F.col(id_col).cast("bigint").alias("__id")).where("__id is not null").unionByName(given)
    held = held.groupBy(F.col("__id").bitwiseAND(F.lit(mask)).alias("__held")).agg(
        (F.max(F.shiftright("__id", bits)) + 1).alias("__next"))
    open_ = F.col(id_col).isNull()
    hashed = rows.withColumn("__key", key).withColumn("__hash", F.when(open_, hashed_id(F.col("__key"), bits)))
    # A row with an id of its own needs no place: a window of its own for each keeps them apart.
    apart = F.when(open_, F.lit(0)).otherwise(F.xxhash64(id_col, "__key"))
    place = F.row_number().over(Window.partitionBy("__hash", apart).orderBy("__key")) - 1
    placed = hashed.withColumn("__place", place).join(held, F.col("__hash") == F.col("__held"), "left")
    turn = F.col("__place") + F.coalesce("__next", F.lit(0))
    fits = F.when(turn > top, F.raise_error(F.lit(f"more than {top + 1} keys have one hash of {bits} bits"))).otherwise(turn)
    new = F.col("__hash") + fits.cast("bigint") * F.lit(1 << bits)
    return placed.withColumn(id_col, F.when(open_, new).otherwise(F.col(id_col))) \
        .drop("__key", "__hash", "__place", "__held", "__next")


def upsert_customers(good: DataFrame, customers: DataFrame, bits: int = ID_BITS) -> DataFrame:
    """Distinct normalised emails of good requests with no customer, as whole rows of the
    customers table (name = local part; both times are the first request's)."""
    emails = good.groupBy(F.col("email_norm").alias("email")).agg(F.min("created_at").alias("__first"))
    new = emails.join(customers.select(F.col("email").alias("__e")),
                      F.col("email") == F.col("__e"), "left_anti")
    new = with_unique_ids(new.withColumn("customer_id", F.lit(None).cast("bigint")), "customer_id", F.col("email"),
                          customers.select("customer_id"), bits)
    return new.select("customer_id", email_local_part("email").alias("name"), "email",
                      F.col("__first").alias("created_at"), F.col("__first").alias("updated_at"))


def ingest_transactions(headers: DataFrame, lines: DataFrame, customers: DataFrame,
                        items: DataFrame, payment_methods: DataFrame,
                        id_col: str = "request_id", persist: bool = False,
                        id_bits: int = ID_BITS) -> IngestResult:
    """M13 on a batch.  Transaction ids are 16 hex digits of SHA-256 over the request id,
    so a recomputed task gives the same id.

    ``persist=True`` keeps the validated requests and priced lines in executor storage
    (memory, spilling to disk) for jobs that write several of the outputs; call
    ``release()`` on the result afterwards.  A lost executor only drops cached blocks,
    which Spark recomputes.
    """
    if persist:
        good, good_lines, rejected, cached = validate_requests(
            headers, lines, items, payment_methods, id_col, persist=True)
    else:
        good, good_lines, rejected = validate_requests(headers, lines, items, payment_methods,
                                                       id_col)
        cached = []
    tid = short_id(id_col, n=ID_HEX_DIGITS)
    new_customers = upsert_customers(good, customers, id_bits)
    # Existing customer by email (one id per email even if the table repeats one, which
    # R12 forbids), or the new customer of that email.
    known = customers.groupBy(F.col("email").alias("__e")).agg(F.min("customer_id").alias("__cid")) \
        .unionByName(new_customers.select(F.col("email").alias("__e"), F.col("customer_id").alias("__cid")))
    g = good.join(known, good["email_norm"] == known["__e"], "left")
    items_out = good_lines.select(
        tid.alias("transaction_id"), "item_id", "quantity", "unit_price",
        (F.col("unit_price") * F.col("quantity")).alias("subtotal"), "created_at")
    # The total comes with the validated request (exact decimal sum of its lines).
    transactions = g.select(
        tid.alias("transaction_id"), F.col("__cid").alias("customer_id"), "payment_method_id",
        "location", F.col("lines_total").cast("double").alias("total_spent"),
        F.lit("completed").alias("status"),
        "created_at", "updated_at")
    errors = rejected.select(
        tid.alias("transaction_id"), "customer_email", "payment_method", "location",
        F.col("created_at").cast("string").alias("transaction_date"), "error_message")
    # The lines of rejected requests as they came, one row each: with ``errors``, the whole request, and no request's
    # lines are gathered in one row.
    error_items = lines.join(rejected.select(id_col), id_col, "left_semi").select(
        tid.alias("transaction_id"), "line_no", "item_name", "quantity")
    return IngestResult(transactions, items_out, new_customers, errors, good, error_items, cached)


def rebuild_requests(errors: DataFrame, error_items: DataFrame) -> DataFrame:
    """Rejected requests with their items, in order, as JSON (transaction_id, error_message, body), for sending again.

    Gathers each request's lines, so it is for requests as a service takes them, not for one with millions of lines."""
    items = error_items.groupBy("transaction_id").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "item_name", "quantity"))).alias("items"))
    body = F.to_json(F.struct("customer_email", F.transform(
        F.coalesce("items", F.array().cast(items.schema["items"].dataType)),
        lambda i: F.struct(i["item_name"].alias("item_name"), i["quantity"].alias("quantity"))).alias("items"),
        "payment_method", "location", F.col("transaction_date").alias("created_at")))
    return errors.join(items, "transaction_id", "left").select("transaction_id", "error_message", body.alias("body"))


# --- reference data (M15) --------------------------------------------------------------

# fixed values: column defaults of the source tables
DEFAULTS = {"status": "completed", "is_active": True}


def with_defaults(df: DataFrame) -> DataFrame:
    """Fill missing status / is_active / created_at / updated_at / text
    transaction_date with their defaults (current time for the times, today for the date), for
    whichever of these columns the frame has."""
    now = F.current_timestamp().cast("timestamp_ntz")
    out = df
    for c in df.columns:
        if c in DEFAULTS:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(DEFAULTS[c])))
        elif c in ("created_at", "updated_at"):
            out = out.withColumn(c, F.coalesce(F.col(c), now))
        elif c == "transaction_date" and df.schema[c].dataType.simpleString() == "string":
            out = out.withColumn(c, F.coalesce(F.col(c), today_text()))
    return out


def add_customers(new: DataFrame, existing: DataFrame, id_bits: int = ID_BITS) -> tuple[DataFrame, DataFrame]:
    """Batch of customers stored as given (M15): defaults, id from the email when missing (good rows only),
    and R12: an email already present, or repeated in the batch, is rejected."""
    staged = with_defaults(new)
    repeated = staged.groupBy("email").agg(F.count(F.lit(1)).alias("__n"))
    taken = existing.select(F.col("email").alias("__taken")).distinct()
    tagged = (staged.join(repeated, "email", "left")
              .join(taken, F.col("email") == F.col("__taken"), "left"))
    good, bad = validate(tagged, [
        (F.col("email").isNull() | is_blank("email"), "Customer email cannot be empty"),
        (F.length("name") > 100, "Customer name is longer than 100"),
        (F.length("email") > 255, "Customer email is longer than 255"),
        (F.col("__taken").isNotNull(), "Customer email already exists"),
        (F.col("__n") > 1, "Customer email repeated in the batch")])
    cols = ["customer_id", "name", "email", "created_at", "updated_at"]
    good = with_unique_ids(good.select(*cols), "customer_id", F.col("email"), existing.select("customer_id"), id_bits)
    return good.select(*cols), bad.select(*cols, "error_message")


def add_payment_methods(new: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Batch of payment methods (M15): is_active defaults to true; names are unique."""
    staged = with_defaults(new)
    repeated = staged.groupBy("name").agg(F.count(F.lit(1)).alias("__n"))
    taken = existing.select(F.col("name").alias("__taken")).distinct()
    tagged = (staged.join(repeated, "name", "left")
              .join(taken, F.col("name") == F.col("__taken"), "left"))
    good, bad = validate(tagged, [
        (F.col("name").isNull() | is_blank("name"), "Payment method name cannot be empty"),
        (F.length("name") > PAYMENT_MAX, f"Payment method is longer than {PAYMENT_MAX}"),
        (F.col("__taken").isNotNull(), "Payment method already exists"),
        (F.col("__n") > 1, "Payment method repeated in the batch")])
    cols = ["payment_method_id", "name", "is_active", "created_at"]
    good = with_unique_ids(good.select(*cols), "payment_method_id", F.col("name"), existing.select("payment_method_id"))
    return good.select(*cols), bad.select(*cols, "error_message")

def item_rules() -> list[tuple[Column, str]]:
    return [
        (F.col("name").isNull() | is_blank("name"), "Item name cannot be empty"),
        (F.col("unit_price").isNull() | (F.col("unit_price") < 0), "unit_price must be >= 0"),
    ]


def add_items(new_items: DataFrame, existing: DataFrame | None = None,
              id_bits: int = ID_BITS) -> tuple[DataFrame, DataFrame]:
    """A batch of new item rows (M15): current time for missing created/updated times,
    price rule R10.  Returns (rows to append, rejected rows with a message).  A missing
    item_id is derived from the row's name and time, and its number among rows with the same ones, so it needs
    no global counter and is the same when a task is recomputed; it differs from all ids of the batch and of
    ``existing``."""
    now = F.current_timestamp().cast("timestamp_ntz")
    staged = new_items.select(
        "item_id", "name", "description", "unit_price",
        F.coalesce("created_at", now).alias("created_at"), F.coalesce("updated_at", now).alias("updated_at"))
    good, bad = validate(staged, item_rules())
    text = F.concat_ws("|", "name", F.col("created_at").cast("string"))
    alike = Window.partitionBy("item_id", "name", "created_at").orderBy("description", "unit_price", "updated_at")
    copy = F.row_number().over(alike)
    good = good.withColumn("__text", F.when(copy == 1, text).otherwise(F.concat_ws("|", text, copy.cast("string"))))
    taken = (new_items if existing is None else existing).select("item_id")
    good = with_unique_ids(good, "item_id", F.col("__text"), taken, id_bits).drop("__text")
    return good.select(*staged.columns), bad
