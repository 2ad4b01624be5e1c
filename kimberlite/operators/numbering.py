"""Row numbers over a whole table without bringing it into one task."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kimberlite.operators.ordering import ascending
from kimberlite.sources.scratch import stage

# monotonically_increasing_id() holds the partition above, the row within it below, this bit.
_PARTITION_SHIFT = 33
_AT, _BEFORE = "_at", "_before"


def number_rows(
    df: DataFrame, order: Sequence[Column], name: str, within: Sequence[str] = ()
) -> DataFrame:
    """Dense numbers 1..N in ``order``, restarting for each ``within`` group if given.

    The rows are range-partitioned and sorted by (within, order), so a group of
    any size spreads over as many tasks as its rows need. The sorted rows are
    staged once with their place; the rows before each partition then come from
    one count per partition. Give a total order: rows that are equal in it stay
    in one partition.
    """
    ordering = ascending(*within) + list(order)
    placed = stage(
        df.repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .withColumn(_AT, F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright(_AT, _PARTITION_SHIFT).cast("int")
    sizes = dict(placed.groupBy(part).count().collect())
    position = F.col(_AT).bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1)) + 1
    if len(sizes) > 1:
        # One number per shuffle partition: bounded by spark.sql.shuffle.partitions.
        before = accumulate((sizes.get(i, 0) for i in range(max(sizes))), initial=0)
        offsets = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
        position = F.element_at(offsets, part + 1) + position
    numbered = placed.select(*df.columns, position.cast("bigint").alias(name))
    if not within:
        return numbered
    starts = numbered.groupBy(*[F.col(c).alias(f"_g_{c}") for c in within]).agg(
        F.min(name).alias(_BEFORE)
    )
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in within]
    restarted = (F.col(name) - F.col(_BEFORE) + 1).alias(name)
    return numbered.join(starts, same).select(*df.columns, restarted)
