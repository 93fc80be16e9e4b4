"""Scalar expressions with the warehouse semantics the jobs rely on.

Each helper returns a ``Column`` built from built-in functions only, so it
stays inside whole-stage codegen.  Where Spark's own function differs from
the semantics wanted (null handling of greatest/least, month boundaries,
leading zeros), the helper spells out the intended rule.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "c", "lit_date", "strict_greatest", "strict_least", "months_crossed", "years_crossed",
    "try_number", "number_text", "prefix", "is_in", "any_null", "money", "to_double",
    "code_between", "yyyymm_to_date", "period_label", "event_id", "bracket_text",
    "days_between_clock", "elapsed_days", "parse_when", "DATE_FORMATS", "null_safe_concat",
]


def c(name_or_col) -> Column:
    return F.col(name_or_col) if isinstance(name_or_col, str) else name_or_col


def lit_date(d) -> Column:
    if isinstance(d, dt.datetime):
        d = d.date()
    return F.lit(d).cast("date")


def any_null(*cols) -> Column:
    return reduce(lambda a, b: a | b, [c(x).isNull() for x in cols])


def strict_greatest(*cols) -> Column:
    """greatest() that is null when any argument is null (warehouse rule)."""
    return F.when(any_null(*cols), F.lit(None)).otherwise(F.greatest(*[c(x) for x in cols]))


def strict_least(*cols) -> Column:
    """least() that is null when any argument is null (warehouse rule)."""
    return F.when(any_null(*cols), F.lit(None)).otherwise(F.least(*[c(x) for x in cols]))


def months_crossed(start, end) -> Column:
    """Month boundaries crossed from start to end (not full months elapsed)."""
    s, e = c(start), c(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


def years_crossed(start, end) -> Column:
    """Year boundaries crossed (the warehouse's datediff('year'))."""
    return F.year(c(end)) - F.year(c(start))


def try_number(col) -> Column:
    """Text -> whole number, null when not numeric (rounds like TRY_TO_NUMBER)."""
    return c(col).try_cast("decimal(38,0)")


def number_text(col) -> Column:
    """Whole number -> text without leading zeros ('0170' -> '170')."""
    return c(col).cast("string")


def prefix(col, n: int = 3) -> Column:
    return F.substring(c(col), 1, n)


def is_in(col, values) -> Column:
    """Membership test against a literal code list (after cast to string)."""
    return c(col).cast("string").isin(list(values))


def money(col) -> Column:
    """Exact decimal amount -> double for output (after exact summation)."""
    return c(col).cast("double")


to_double = money


def code_between(col, lo: str, hi: str) -> Column:
    """Lexicographic range test on code text, as the warehouse compares strings."""
    return c(col).between(F.lit(lo), F.lit(hi))


def yyyymm_to_date(col) -> Column:
    """'YYYYMM' -> first day of the month; bad text -> null."""
    return F.try_to_date(F.concat(c(col), F.lit("01")), "yyyyMMdd")


def period_label(start: dt.date, end: dt.date) -> str:
    """'Mon YYYY - Mon YYYY' label, computed once on the driver from config."""
    return f"{start:%b %Y} - {end:%b %Y}"


def event_id(member, day) -> Column:
    """member || yyyy || mm || dd (null if either is null)."""
    d = c(day)
    return F.concat(
        c(member),
        F.lpad(F.year(d).cast("string"), 4, "0"),
        F.lpad(F.month(d).cast("string"), 2, "0"),
        F.lpad(F.dayofmonth(d).cast("string"), 2, "0"),
    )


def bracket_text(col) -> Column:
    """Text inside the first [...]; null when there is none (pandas extract)."""
    t = c(col)
    return F.when(t.rlike(r"\[(.*?)\]"), F.regexp_extract(t, r"\[(.*?)\]", 1))


def elapsed_days(start, end) -> Column:
    """Whole days elapsed from start to end, floored (23 hours are 0 days, minus 1 hour is -1)."""
    micros = F.unix_micros(c(end).cast("timestamp")) - F.unix_micros(c(start).cast("timestamp"))
    return F.floor(micros / 86_400_000_000).cast("int")


def days_between_clock(as_of: dt.date | dt.datetime, col) -> Column:
    """Whole days elapsed from a date/timestamp to the as-of clock, floored."""
    return elapsed_days(col, F.lit(str(as_of)).cast("timestamp"))


# Text dates that are read beside ISO ones, in this order; month before day, as in the US.
DATE_FORMATS = ("M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy h:mm a", "M/d/yyyy h:mm:ss a",
                "yyyy/M/d", "yyyyMMdd", "d MMM yyyy", "d-MMM-yyyy", "MMM d, yyyy", "MMMM d, yyyy")


def parse_when(df, name: str, formats=DATE_FORMATS) -> Column:
    """A column as timestamp: dates and timestamps as they are, text by ISO or
    the first of ``formats`` that fits, anything else null."""
    col = F.col(f"`{name}`")
    if df.schema[name].dataType.typeName() in ("date", "timestamp", "timestamp_ntz"):
        return col.cast("timestamp")
    text = F.trim(col.cast("string"))
    # Eight digits would pass as an ISO year.
    iso = F.when(~text.rlike("^[0-9]+$"), F.try_to_timestamp(text))
    return F.coalesce(iso, *[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def null_safe_concat(prefix_text: str, col) -> Column:
    return F.when(c(col).isNotNull(), F.concat(F.lit(prefix_text), c(col).cast("string")))
