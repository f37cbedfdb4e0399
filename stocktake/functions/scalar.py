"""Scalar helpers as Column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings that count as missing.
NULL_MARKERS = ("", "null", "none", "na", "n/a", "nan", "-")
# The smaller, case-sensitive set used when casting.
CAST_NULLS = ("", "null", "none")

# Fixed value: what counts as white space at either end of a value.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Python's int() and float() literals (without underscores). Spark's own casts accept
# more, such as "5d", so values are checked before the cast.
INT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_PATTERN = (
    r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\s*$"
)


def strip(c: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.btrim(c, F.lit(BLANKS))


def is_missing(c: Column) -> Column:
    return c.isNull() | F.lower(strip(c.cast("string"))).isin(*NULL_MARKERS)


def full_name(first: Column, last: Column) -> Column:
    """``first || ' ' || last``: NULL when either part is NULL."""
    return F.concat(first, F.lit(" "), last)


def parse_as(c: Column, kind: str) -> Column:
    """Value of type int / float / str, NULL when the text is no such literal."""
    if kind == "int":
        return F.when(strip(c).rlike(INT_PATTERN), strip(c).try_cast("bigint"))
    if kind == "float":
        return F.when(strip(c).rlike(FLOAT_PATTERN), strip(c).try_cast("double"))
    return c


def month_of(c: Column) -> Column:
    return F.trunc(c.cast("date"), "month")


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def padded_day_name(c: Column) -> Column:
    """Weekday name, blank-padded to nine characters."""
    return F.rpad(F.date_format(c, "EEEE"), 9, " ")


def months_between_months(later: Column, earlier: Column) -> Column:
    """Whole months between two first-of-month dates; negative when reversed."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def in_year(c: Column, year: int) -> Column:
    """``year(c) = year`` as a half-open range, which the parquet reader can skip by."""
    return (c >= F.lit(dt.datetime(year, 1, 1)).cast("timestamp_ntz")) & (
        c < F.lit(dt.datetime(year + 1, 1, 1)).cast("timestamp_ntz")
    )


def percent_change(value: Column, base: Column, digits: int) -> Column:
    """(value - base) / base in percent; NULL when the base is NULL or zero."""
    return F.round((value - base) / F.nullif(base, F.lit(0)) * 100, digits)


def share_percent(part: Column, whole: Column, digits: int) -> Column:
    whole = F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round(part.cast("decimal(20,0)") / whole * 100, digits)


def number_text(c: Column) -> Column:
    """A double as plain digits where Spark's own text has an exponent but the number has
    few enough digits to be written out: 10000000.0 and not 1.0E7."""
    size = F.abs(c)
    written_out = ((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3))
    digits = F.regexp_replace(c.cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(written_out, digits).otherwise(c.cast("string"))


def quote_sql(c: Column) -> Column:
    """A string as an SQL literal, quotes doubled."""
    return F.concat(F.lit("'"), F.replace(c, F.lit("'"), F.lit("''")), F.lit("'"))
