"""Cleaners from raw text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kimberlite.functions.exact import nearest

# The space separators that the SQL side's TRIM strips.
BLANKS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def raw(c: Column | str) -> Column:
    """Text as it came."""
    return _col(c)


def text(c: Column | str) -> Column:
    """Text without blanks at either end."""
    return F.trim(_col(c), F.lit(BLANKS))


def upper_text(c: Column | str) -> Column:
    return F.upper(text(c))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(text(c), F.lit(""))


def whole(c: Column | str) -> Column:
    """Text to int; ``14.0`` is 14, ``4.5`` rounds away from zero, other text fails."""
    return nearest(_col(c).cast("double")).cast("int")


def number(c: Column | str) -> Column:
    return _col(c).cast("double")


def flag(c: Column | str) -> Column:
    return _col(c).cast("boolean")


def day(c: Column | str) -> Column:
    return _col(c).cast("date")


def instant(c: Column | str) -> Column:
    """Text to a timestamp without zone."""
    return _col(c).cast("timestamp_ntz")


def digits(c: Column | str) -> Column:
    """Text with every non-digit removed."""
    return F.regexp_replace(_col(c), "[^0-9]", "")


def digits_after_first_strip(c: Column | str) -> Column:
    """Text with only its first non-digit removed."""
    return F.regexp_replace(_col(c), "^([0-9]*)[^0-9]", "$1")
