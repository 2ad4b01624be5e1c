"""Joins whose many side may hold a large part of its rows under one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_many(one: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """``one`` left join ``many``, so that a large key of ``many`` can be split.

    A left join cannot split a large group on its right side. The matches are an
    inner join, whose large partitions adaptive execution splits, and the rows of
    ``one`` without a match are an anti join against the distinct keys. A NULL
    key has no match. Neither side is broadcast: both may be as large as a fact,
    and the size of their files says little of their size in memory.
    """
    matched = many.join(one.hint("merge"), key).select(*one.columns, *[c for c in many.columns if c != key])
    alone = one.join(many.select(key).distinct().hint("merge"), key, "left_anti")
    missing = {f.name: F.lit(None).cast(f.dataType) for f in many.schema if f.name != key}
    return matched.unionByName(alone.withColumns(missing))
