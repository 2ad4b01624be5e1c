"""Numbering the lines of an order and spreading header amounts over them.

Lines are sorted by (group, order) over range partitions and staged, so a group
of any size lies in as many partitions as its rows need. What a line needs to
know of its group comes from one row per group and partition: rows, weights and
amounts are summed there first, then over the few partitions of a group, and
joined back by group and partition. No task ever holds a whole large group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kimberlite.functions.exact import to_decimal
from kimberlite.operators.ordering import ascending
from kimberlite.sources.scratch import stage

EXACT = (18, 8)
SCALE = 4
MONEY = f"decimal(18,{SCALE})"
WEIGHT = "decimal(28,8)"
ADDED = ("line_number", "line_count", "line_total_of_group", "line_share")

_PART, _AT = "_line_part", "_line_at"
_GROUP, _OF = "_sum_group", "_sum_part"


def number_lines(df: DataFrame, group: str, order: Sequence[Column], weight: str) -> DataFrame:
    """Add ``line_number``, ``line_count``, ``line_total_of_group`` and ``line_share``.

    The share is zero where the group's total is zero. NULL is a group of its
    own. ``order`` must be total within a group.
    """
    return _numbered(df, group, order, weight).drop(_PART)


def allocate(
    df: DataFrame, group: str, order: Sequence[Column], weight: str, amounts: Mapping[str, str]
) -> DataFrame:
    """Spread amounts in proportion to ``weight`` so that each group adds up exactly.

    ``amounts`` maps each output column to the DECIMAL(18,8) column to spread,
    which is constant in its group. Lines get their rounded part, the last line
    what the others left over; a group without weights keeps its amounts there.
    ``order`` must be total within a group.
    """
    lines = _with_parts(_numbered(df, group, order, weight), amounts)
    not_last = F.col("line_number") < F.col("line_count")
    spent = lines.groupBy(group, _PART).agg(
        *[F.sum(F.when(not_last, F.col(f"_part{i}"))).alias(f"_spent{i}") for i in range(len(amounts))]
    )
    whole = Window.partitionBy(group)
    priors = spent.select(
        F.col(group).alias(_GROUP),
        F.col(_PART).alias(_OF),
        *[F.sum(f"_spent{i}").over(whole).alias(f"_prior{i}") for i in range(len(amounts))],
    )
    lines = _joined(lines, priors, group)
    return lines.withColumns(_settle(amounts)).select(*df.columns, *ADDED, *amounts)


def _numbered(df: DataFrame, group: str, order: Sequence[Column], weight: str) -> DataFrame:
    ordering = ascending(group) + list(order)
    placed = stage(
        df.repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .withColumns({_PART: F.spark_partition_id(), _AT: F.monotonically_increasing_id()}),
        "lines",
    )
    parts = placed.groupBy(group, _PART).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(_exact(weight)).alias("_weight"), F.min(_AT).alias("_first")
    )
    whole = Window.partitionBy(group)
    earlier = whole.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.select(
        F.col(group).alias(_GROUP),
        F.col(_PART).alias(_OF),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("line_count"),
        F.sum("_weight").over(whole).cast(WEIGHT).alias("line_total_of_group"),
    )
    lines = _joined(placed, sums, group)
    number = (F.col(_AT) + F.col("_shift") + 1).cast("bigint")
    total = F.col("line_total_of_group")
    share = F.try_divide(F.col(weight).cast("double"), total.cast("double"))
    return lines.select(
        *df.columns,
        _PART,
        number.alias("line_number"),
        "line_count",
        "line_total_of_group",
        F.when(total == 0, F.lit(0.0)).otherwise(share).alias("line_share"),
    )


def _joined(lines: DataFrame, sums: DataFrame, group: str) -> DataFrame:
    same = F.col(group).eqNullSafe(F.col(_GROUP)) & (F.col(_PART) == F.col(_OF))
    return lines.join(sums, same).drop(_GROUP, _OF)


def _exact(weight: str) -> Column:
    return to_decimal(F.col(weight).cast("double"), *EXACT)


def _with_parts(df: DataFrame, amounts: Mapping[str, str]) -> DataFrame:
    return df.withColumns(
        {
            f"_part{i}": to_decimal(F.col("line_share") * F.col(a).cast("double"), 18, SCALE)
            for i, a in enumerate(amounts.values())
        }
    )


def _settle(amounts: Mapping[str, str]) -> dict[str, Column]:
    last = F.col("line_number") == F.col("line_count")
    settled = {}
    for i, (name, amount) in enumerate(amounts.items()):
        rest = F.col(amount) - F.coalesce(F.col(f"_prior{i}"), F.lit(0).cast(MONEY))
        settled[name] = F.when(last, rest.cast(MONEY)).otherwise(F.col(f"_part{i}"))
    return settled
