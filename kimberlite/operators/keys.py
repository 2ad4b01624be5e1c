"""Surrogate keys and their lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kimberlite.operators.numbering import number_rows

UNKNOWN_KEY = -1


def surrogate_key(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add the dense key 1..N in business-key order."""
    return number_rows(df, order, name)


def lookup_key(
    rows: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    key: str,
    alias: str | None = None,
    default: int | None = UNKNOWN_KEY,
    many: bool = False,
) -> DataFrame:
    """Add the dimension's ``key`` for each row; a miss or a NULL gets ``default``.

    ``on`` maps row columns to dimension columns. Spark broadcasts the two or
    three dimension columns when their size allows it and else runs a sort-merge
    join, whose left side adaptive execution splits on skewed keys. ``many`` is for
    dimensions that grow with the data, customers or products: never broadcast.
    """
    alias = alias or key
    wanted = {d: f"_d_{d}" for d in on.values()}
    slim = dimension.select(
        *[F.col(d).alias(a) for d, a in wanted.items()], F.col(key).alias("_d_key")
    )
    if many:
        slim = slim.hint("merge")
    match = [F.col(r) == F.col(wanted[d]) for r, d in on.items()]
    found = F.col("_d_key")
    if default is not None:
        found = F.coalesce(found, F.lit(default).cast(dimension.schema[key].dataType))
    return rows.join(slim, match, "left").select(
        *[c for c in rows.columns if c != alias], found.alias(alias)
    )
