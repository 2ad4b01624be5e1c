"""Doubles to fixed decimals and to text, the same on every engine."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def nearest(value: Column) -> Column:
    """Double rounded to the nearest whole number, halves away from zero.

    The same as ``round`` but in plain double arithmetic, several times faster.
    """
    even = F.rint(value)
    half = F.abs(value - even) == 0.5
    return F.when(half, value + F.signum(value) * 0.5).otherwise(even)


def to_decimal(value: Column, precision: int, scale: int) -> Column:
    """Double to DECIMAL(precision, scale), rounding the scaled double half away from zero.

    A plain cast rounds the decimal text of the double instead, which differs on ties.
    """
    units = nearest(value * F.lit(float(10**scale))).cast("bigint").cast("decimal(18,0)")
    return (units * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal({precision},{scale})")


def double_text(value: Column) -> Column:
    """Shortest text of a double: plain digits from 1e-4 up to 1e16, else like ``1e-05``.

    The JVM's own text has a digit too many for some large doubles, so there the
    fewest digits are taken that read back as the same double.
    """
    size = F.abs(value)
    plain = F.rtrim(value.cast("decimal(38,20)").cast("string"), F.lit("0"))
    plain = F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain)
    exact = F.format_string("%.16e", value)
    for digits in (15, 14):
        fewer = F.format_string(f"%.{digits}e", value)
        exact = F.when(fewer.try_cast("double") == value, fewer).otherwise(exact)
    mantissa = F.rtrim(F.rtrim(F.substring_index(exact, "e", 1), F.lit("0")), F.lit("."))
    power = F.concat(mantissa, F.lit("e"), F.substring_index(exact, "e", -1))
    return (
        F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), value.cast("string"))
        .when((size >= 1e-4) & (size < 1e16), plain)
        .when(F.isnan(value), "nan")
        .when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when(value.isNotNull(), power)
    )
