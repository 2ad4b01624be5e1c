"""Telling rows of a table of texts apart by id and the hash of the text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kimberlite.llm.staged import broadcast_if_few
from kimberlite.sources.scratch import stage

_ID, _HASH = "__key_id", "__key_hash"


def told_apart(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``(id, text_hash, text)``."""
    return docs.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.xxhash64(text_column).alias("text_hash"),
        F.col(text_column).alias("text"),
    )


def rows_with(docs: DataFrame, keys: DataFrame, id_column: str, text_column: str, how: str) -> DataFrame:
    """Semi or anti join of ``docs`` with ``keys(id, text_hash)``, null ids being equal."""
    named = keys.select(F.col(id_column).alias(_ID), F.col("text_hash").alias(_HASH)).distinct()
    few = broadcast_if_few(stage(named, "keys"))
    same = docs[id_column].eqNullSafe(few[_ID]) & (F.xxhash64(docs[text_column]) == few[_HASH])
    return docs.join(few, same, how)


def once(docs: DataFrame, found: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``docs`` with one row for each id and text; ``found`` has a row for each, with their keys.

    Only the rows that repeat are shuffled with their text.
    """
    repeated = found.groupBy(id_column, "text_hash").count().filter("count > 1").drop("count")
    single = rows_with(docs, repeated, id_column, text_column, "left_anti")
    several = rows_with(docs, repeated, id_column, text_column, "left_semi").withColumn(_HASH, F.xxhash64(text_column))
    return single.unionByName(several.dropDuplicates([id_column, _HASH]).drop(_HASH))
