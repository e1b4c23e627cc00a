"""Scalar expressions of the reports. All are built-in Spark expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text form of milestone times, the unit divisor (pounds per short ton) and the
# characters that count as blanks around an identifier.
ISO_TEXT = r"^([+-]?\d+)-(\d\d)-(\d\d) (\d\d:\d\d:\d\d).*$"
EVENT_TEXT = "$2-$3-$1 $4"
POUNDS_PER_TON = 2000
BLANKS = " \t\n\r\f\x0b"
DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def event_text(time: Column) -> Column:
    """Month-first text of a time without a zone; ``date_format`` would shift it into the session's zone."""
    return F.regexp_replace(time.cast("string"), ISO_TEXT, EVENT_TEXT)


def sql_text(value: object) -> str:
    """A value as a quoted SQL literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip(text: Column) -> Column:
    """Remove blanks of any kind from both ends."""
    return F.btrim(text, F.lit(BLANKS))


def strip_sql(column: str) -> str:
    """The same as SQL text, for lists of many columns."""
    blanks = "".join(f"\\u{ord(blank):04x}" for blank in BLANKS)
    return f"btrim({column}, '{blanks}')"


def zero_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(0).cast("double"))


def short_tons(pounds: Column) -> Column:
    return pounds / POUNDS_PER_TON


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with fractions, rounded to milliseconds."""
    return F.round(F.timestamp_diff("MICROSECOND", start, end) / 1e6, 3)


def free_open_text(flag: Column) -> Column:
    """Only a stored '0' means FALSE; a missing flag reads as TRUE."""
    return F.when(flag == "0", "FALSE").otherwise("TRUE")


def lenient_bigint(text: Column) -> Column:
    """Number in a text, cut to an integer; anything unreadable or missing gives 0.

    Only plain decimals are read: a cast alone would also take type suffixes and hexadecimal floats.
    """
    plain = F.when(text.rlike(DECIMAL), text)
    whole = plain.try_cast("bigint")
    cut = plain.try_cast("double").try_cast("bigint")
    return F.coalesce(whole, cut, F.lit(0).cast("bigint"))


def matches(text: Column, pattern: str, case_sensitive: bool = True) -> Column:
    """SQL LIKE. Catalyst turns '%x%' and 'x%' into pushed contains/starts-with filters."""
    return text.like(pattern) if case_sensitive else text.ilike(pattern)


def wide_name(prefix: str, name: str) -> str:
    """Column name of a vocabulary entry: prefix plus the name with blanks as underscores."""
    return prefix + re.sub(r"\s+", "_", name.strip())
