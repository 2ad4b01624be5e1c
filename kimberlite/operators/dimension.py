"""Dimension tables: key, attributes, hash, load times and the unknown member."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kimberlite.functions.calendar import calendar_columns
from kimberlite.functions.digest import row_hash
from kimberlite.operators.keys import UNKNOWN_KEY, surrogate_key
from kimberlite.operators.ordering import ascending


@dataclass(frozen=True)
class Dimension:
    """What a dimension looks like.

    ``columns`` are the attributes in output order, ``order`` the business key
    that numbers the rows, ``tie_break`` more body columns that make that order
    total, ``digest`` the hashed columns with their text for NULL, ``unknown``
    the attribute values of the unknown member other than NULL.
    """

    key: str
    columns: Sequence[str]
    order: Sequence[str]
    digest: Sequence[tuple[str, str]]
    tie_break: Sequence[str] = ()
    unknown: dict[str, object] = field(default_factory=dict)
    unknown_hash: bytes | None = None


def load_times() -> list[Column]:
    return [F.current_timestamp().alias("_insert_ts"), F.current_timestamp().alias("_update_ts")]


def unknown_member(spark: SparkSession, spec: Dimension, types: dict) -> DataFrame:
    """The one row that stands for a missing reference."""
    values = [F.lit(spec.unknown.get(c)).cast(types[c]).alias(c) for c in spec.columns]
    return spark.range(1).select(
        F.lit(UNKNOWN_KEY).cast("bigint").alias(spec.key),
        *values,
        F.lit(spec.unknown_hash).cast("binary").alias("_hash"),
        *load_times(),
    )


def build_dimension(body: DataFrame, spec: Dimension) -> DataFrame:
    """Number and hash the body rows and put the unknown member in front."""
    needed = dict.fromkeys(
        [*spec.columns, *spec.order, *spec.tie_break, *(name for name, _ in spec.digest)]
    )
    body = body.select(*needed)
    keyed = surrogate_key(body, ascending(*spec.order, *spec.tie_break), spec.key)
    members = keyed.select(
        spec.key, *spec.columns, row_hash(keyed, spec.digest).alias("_hash"), *load_times()
    )
    types = {f.name: f.dataType for f in body.schema}
    return unknown_member(body.sparkSession, spec, types).unionByName(members)


def date_dimension(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    bounds = spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
    return _calendar(bounds)


def date_dimension_for(df: DataFrame, day: str) -> DataFrame:
    """One row per day of the years that a date column covers."""
    covered = df.agg(F.min(day).alias("low"), F.max(day).alias("high"))
    return _calendar(
        covered.select(
            F.make_date(F.year("low"), F.lit(1), F.lit(1)).alias("first"),
            F.make_date(F.year("high"), F.lit(12), F.lit(31)).alias("last"),
        )
    )


def _calendar(bounds: DataFrame) -> DataFrame:
    days = bounds.select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day")
    )
    return days.select(*calendar_columns(F.col("day")))
