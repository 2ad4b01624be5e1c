"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kimberlite.sources.scratch import stage


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``: the smallest node it reaches.

    Stars are merged in turns: each node points its larger neighbours at its
    smallest neighbour, then itself and its smaller ones. The edges keep their
    components and, after a few turns (logarithmic in the longest path in
    practice), are one star per component. Minima are partial aggregates, a hub
    only meets its one row again, and each turn is written to shared storage.
    Edges with a NULL end and loops are ignored.
    """
    plain = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = stage(plain.filter("u <> v").distinct(), "edges")
    state = _state(now)
    while True:
        now = stage(_small(_large(now)), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges: their number and two sums of hashes."""
    row = edges.agg(
        F.count(F.lit(1)),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        F.sum(F.hash("v", "u").cast("bigint")),
    ).first()
    return tuple(row)


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = both.filter("v > u")
    return (
        larger.join(least, larger["u"] == least["w"])
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    moved = edges.join(least, edges["u"] == least["w"]).filter("v <> m")
    return (
        moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
        .distinct()
    )
