"""Column expressions used across the jobs.  All are built-in Spark functions, so they
stay inside whole-stage code generation; none is a Python UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "to_long", "to_double", "to_date_safe", "to_decimal", "to_ts", "month_start",
    "strip", "strip_lower", "is_blank", "email_local_part", "short_id", "within_length",
    "messages", "all_of", "any_of", "names_unique", "today_text",
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- casts (X1, X2, X3, X5, X14) -------------------------------------------------------
# try_cast, never cast: with ANSI on, a cast of a dirty value raises and fails the job.

def to_long(x) -> Column:
    return _c(x).try_cast("bigint")


def to_double(x) -> Column:
    return _c(x).try_cast("double")


def to_date_safe(x) -> Column:
    return _c(x).try_cast("date")


def to_decimal(x, precision: int = 38, scale: int = 9) -> Column:
    return _c(x).cast(f"decimal({precision},{scale})")


def to_ts(x) -> Column:
    """date -> timestamp at midnight (wall clock, no zone)."""
    return _c(x).cast("timestamp_ntz")


def month_start(x) -> Column:
    """Truncate a date to the first of its month, keeping DATE type."""
    return F.trunc(_c(x), "MM")


# --- text (X6, X7, X8, X10, X12) -------------------------------------------------------

# fixed values: the whitespace characters stripped from text fields (Unicode White_Space and
# the four ASCII separators)
WHITESPACE = (" \t\n\u000b\f\r\u001c\u001d\u001e\u001f\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004"
              "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip(x) -> Column:
    """Remove leading and trailing Unicode whitespace; Spark's one-argument trim takes
    spaces only.  A character-set trim, not a regular expression."""
    return F.btrim(_c(x), F.lit(WHITESPACE))


def strip_lower(x) -> Column:
    return F.lower(strip(x))


def is_blank(x) -> Column:
    return F.length(strip(x)) == 0


def email_local_part(x) -> Column:
    return F.split(_c(x), "@", 2).getItem(0)


def within_length(x, n: int) -> Column:
    """NULL-safe length rule: a NULL value passes (the length limit is not a NOT NULL)."""
    return F.coalesce(F.length(_c(x)) <= n, F.lit(True))


def today_text() -> Column:
    return F.date_format(F.current_date(), "yyyy-MM-dd")


# --- ids (X9) --------------------------------------------------------------------------

def short_id(*seed_cols, n: int = 16) -> Column:
    """First ``n`` hex digits of SHA-256 over a seed.

    Pass a natural key for ids that stay the same when a task is recomputed; with no
    columns a random ``uuid()`` is the seed, as in the source system (write such rows
    once, since a recompute gives new ids).
    """
    seed = F.concat_ws("\u0001", *[_c(c).cast("string") for c in seed_cols]) if seed_cols \
        else F.expr("uuid()")
    return F.substring(F.sha2(seed, 256), 1, n)


# --- rule helpers (X13, X16) -----------------------------------------------------------

def messages(*pairs: tuple[Column, str]) -> Column:
    """Join the messages of failed rules with '; '; NULL when every rule passes.

    Each pair is (condition that marks a FAILURE, message).  A NULL condition counts as
    passed, so rules on optional fields need no extra NULL handling.
    """
    parts = F.array(*[F.when(cond, F.lit(msg)) for cond, msg in pairs])
    joined = F.array_join(F.filter(parts, lambda m: m.isNotNull()), "; ")
    return F.when(F.length(joined) > 0, joined)


def all_of(conds) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def any_of(conds) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def names_unique(arr: Column) -> Column:
    return F.size(F.array_distinct(arr)) == F.size(arr)
