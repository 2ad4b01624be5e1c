"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kimberlite.operators.ordering import ascending, descending

_RANK = "_rank"


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark limits each group to one row before the shuffle as well (a partial
    window group limit), so a key that holds a large part of the table sends
    one row per input task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_by(
    df: DataFrame, keys: Sequence[str], newest: str, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """The newest row of each key; ties go to the smallest remaining columns."""
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c != newest]
    return first_by(df, keys, descending(newest) + ascending(*tie_break))


def any_by(df: DataFrame, keys: Sequence[str], tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row of each key, chosen by the smallest remaining columns."""
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys]
    return first_by(df, keys, ascending(*tie_break))
