"""Centroid clustering with bounds that are loosened by geometry instead of full drift.

Each vector carries its cluster, an upper bound of the distance to its centroid
and a lower bound of the distance to all others. When centroids have moved, the
vectors of a cluster lie in a sphere around the old centroid. By how much the
distance to another centroid can have shrunk for a point in that sphere is read
off in the plane of the sphere's centre and the two places of that centroid; it
is at most the drift and mostly far less. Only vectors whose bounds meet are
compared with all centroids, exactly, in whole numbers.

One turn is one pass over the vectors, written to shared storage, and one
aggregate of as many rows as there are clusters. Nothing is grouped by key
otherwise, so clusters of any size spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kimberlite.llm.staged import result
from kimberlite.llm.whole_vectors import EXACT, finite, matrix, whole, widest, within
from kimberlite.sources.scratch import discard, stage

#: Bounds that are nearer than this, relatively, count as equal.
SLACK = 1e-9


@dataclass
class Move:
    """How far centroids moved, and what that does to the bounds of each cluster's vectors."""

    drift: np.ndarray
    loosening: np.ndarray


def shrinkage(centre: np.ndarray, radius: float, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """By how much the distance to each centroid can have shrunk for points of a sphere, at most.

    For a point x, m the middle of the way from ``before`` to ``after``, d its
    length and z the part of x - m along it, the difference of the distances is
    2 d z / (sum of both distances). That sum is at least 2 |x - m|, so the
    difference is at most d cos(angle of x seen from m), and the smallest angle
    of a sphere seen from m is known. The sum is also at least that of the
    sphere's centre less twice the radius, and z at most that of the centre plus
    the radius; the smaller of both limits holds.
    """
    way = after - before
    d = np.sqrt((way**2).sum(axis=1))
    middle = (before + after) / 2
    off = centre - middle
    far = np.sqrt((off**2).sum(axis=1))
    along = np.divide((off * way).sum(axis=1), d, out=np.zeros_like(d), where=d > 0)
    outside = far > radius
    safe = np.where(outside, far, 1.0)
    angle = np.arccos(np.clip(along / safe, -1, 1)) - np.arcsin(np.clip(radius / safe, 0, 1))
    by_angle = np.where(outside, d * np.cos(np.clip(angle, 0, np.pi / 2)), d)
    both = np.sqrt(((centre - before) ** 2).sum(axis=1)) + np.sqrt(((centre - after) ** 2).sum(axis=1))
    least = np.maximum(d, both - 2 * radius)
    by_sum = np.divide(2 * d * (along + radius), least, out=np.zeros_like(d), where=least > 0)
    tight = np.clip(np.minimum(by_angle, by_sum), 0, d)
    return np.where(d > 0, np.minimum(tight * (1 + SLACK) + SLACK * (radius + far), d), 0.0)


def moved(before: np.ndarray, after: np.ndarray, radius: np.ndarray) -> Move:
    """Drift of each centroid, and the loosening of the lower bounds in each cluster."""
    one, two = before.astype(np.float64), after.astype(np.float64)
    drift = np.sqrt(((two - one) ** 2).sum(axis=1))
    loosening = np.zeros(len(one))
    for a in range(len(one)):
        shrunk = shrinkage(one[a], radius[a], one, two)
        shrunk[a] = 0.0
        loosening[a] = shrunk.max()
    return Move(drift, loosening)


def half_gaps(centres: np.ndarray) -> np.ndarray:
    """Half the distance from each centroid to the nearest other one."""
    points = centres.astype(np.float64)
    gaps = np.full(len(points), np.inf)
    for a in range(len(points)):
        others = np.delete(points, a, axis=0)
        if len(others):
            gaps[a] = np.sqrt(((others - points[a]) ** 2).sum(axis=1).min()) / 2
    return gaps


def nearest(
    points: np.ndarray,
    centres: np.ndarray,
    cluster: np.ndarray,
    upper: np.ndarray,
    lower: np.ndarray,
    move: Move | None,
    exact: bool,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Clusters, bounds, squared distances (where known, else -1) and which vectors met all centroids.

    With ``exact``, all distances are known.
    """
    n = len(points)
    cluster, squared = cluster.copy(), np.full(n, -1, np.int64)
    if move is None:
        scan = np.arange(n)
        upper, lower = np.zeros(n), np.zeros(n)
    else:
        upper = upper + move.drift[cluster]
        lower = np.maximum(lower - move.loosening[cluster], 0.0)
        apart = np.maximum(lower, half_gaps(centres)[cluster])
        unsure = upper * (1 + SLACK) + SLACK >= apart
        known = np.flatnonzero(unsure | exact)
        squared[known] = ((points[known] - centres[cluster[known]]) ** 2).sum(axis=1)
        upper[known] = np.sqrt(squared[known])
        scan = np.flatnonzero(unsure & (upper * (1 + SLACK) + SLACK >= apart))
    if len(scan):
        p = points[scan]
        distance = (p**2).sum(axis=1)[:, None] - 2 * (p @ centres.T) + (centres**2).sum(axis=1)[None, :]
        best = distance.argmin(axis=1)  # of equal ones the first
        rows = np.arange(len(scan))
        least = distance[rows, best]
        cluster[scan], squared[scan], upper[scan] = best, least, np.sqrt(least)
        if len(centres) > 1:
            distance[rows, best] = distance.max() + 1
            lower[scan] = np.sqrt(distance.min(axis=1))
        else:
            lower[scan] = np.inf
    scanned = np.zeros(n, bool)
    scanned[scan] = True
    return cluster, upper, lower, squared, scanned


def centroid_clusters(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 40,
    rounds: int = 5,
    size: int = 64,
    scale: int = 256,
    salt: str = "2",
) -> DataFrame:
    """``(id, cluster, distance, cluster_size, cluster_inertia, inertia, centroid, n_scans)`` for each vector kept.

    Vectors of exactly ``size`` components, none null or not finite, are kept;
    each component x becomes ``floor(scale * x)``. Centroids start as the ``k``
    kept vectors with the smallest hexadecimal sha256 of ``salt:id``, in that
    order; equal hashes (rows that repeat an id) by vector, rows without an id
    last. Each of ``rounds`` turns assigns every vector to the nearest centroid,
    by squared distance, ties to the smaller number, then sets each centroid that
    has vectors to the floor of their mean. Then vectors are assigned once more.
    Distances are exact. ``n_scans`` counts how often the vector was compared
    with all centroids, once at least.

    With fewer vectors than ``k``, each is a centroid. Rows that repeat count as
    rows. Components beyond what a squared distance of 64 bits can hold (about
    ``2**27 / scale`` in 64 dimensions) are treated like those that are not
    finite. Other columns are not read. An empty table gives an empty result.

    The driver holds the centroids and one row of sums for each of them.
    """
    spark = vectors.sparkSession
    limit = widest(size, 60)

    def make() -> DataFrame:
        vector = F.col(vector_column).alias("vector")
        plain = vectors.select(F.col(id_column).alias("id"), vector)
        good = finite("vector") & (F.size("vector") == size)
        good = F.when(good, within("vector", scale, limit)).otherwise(False)
        kept = plain.withColumn("good", good).filter("good").select("id", whole("vector", scale).alias("v"))
        state = stage(kept, "vectors")
        chosen = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256).asc_nulls_last()
        seeds = state.orderBy(chosen, "v").limit(k).select("v").collect()
        if not seeds:
            empty = ", ".join(f"cast(null as {t}) as {c}" for c, t in _RESULT.items())
            return state.select(F.col("id").alias(id_column), *[F.expr(e) for e in empty.split(", ")])
        centres = np.array([s["v"] for s in seeds], np.int64)
        wide = state.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0]
        in_doubles = size * (2 * int(wide)) ** 2 < EXACT
        move, left = None, rounds
        while True:
            passed = stage(_assigned(state, centres, move, size, in_doubles, last=not left), "assigned")
            discard(state)
            state = passed
            if not left:
                return _described(state, centres, id_column)
            centres, move = _updated(state, centres, size, in_doubles)
            left = left - 1 if move.drift.any() else 0

    return result(spark, make)


_RESULT = {
    "cluster": "int",
    "distance": "bigint",
    "cluster_size": "bigint",
    "cluster_inertia": "bigint",
    "inertia": "bigint",
    "centroid": "array<bigint>",
    "n_scans": "int",
}


def _assigned(
    state: DataFrame, centres: np.ndarray, move: Move | None, size: int, in_doubles: bool, last: bool
) -> DataFrame:
    first = move is None
    held = centres.astype(np.float64) if in_doubles else centres

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = matrix(batch.column("v"), size, in_doubles)
            n = len(points)
            if first:
                old, up, low, scans = np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.zeros(n, np.int32)
            else:
                old, up, low, scans = (batch.column(c).to_numpy() for c in ("cluster", "upper", "lower", "n_scans"))
            cluster, up, low, squared, scanned = nearest(points, held, old, up, low, move, last)
            columns = {"id": batch.column("id")}
            if last:
                columns |= {"cluster": pa.array(cluster, pa.int32()), "distance": pa.array(squared)}
            else:
                columns |= {
                    "v": batch.column("v"),
                    "cluster": pa.array(cluster, pa.int32()),
                    "upper": pa.array(up),
                    "lower": pa.array(low),
                }
            columns["n_scans"] = pa.array(scans + scanned, pa.int32())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kind = state.schema["id"].dataType.simpleString()
    found = "distance bigint" if last else "upper double, lower double"
    vector = "" if last else "v array<int>, "
    return state.mapInArrow(assign, f"id {kind}, {vector}cluster int, {found}, n_scans int")


def _updated(
    state: DataFrame, centres: np.ndarray, size: int, in_doubles: bool
) -> tuple[np.ndarray, Move]:
    """The moved centroids; one row of sums for each cluster comes to the driver."""

    def part(i: int) -> Column:
        value = F.col("v")[i].cast("bigint" if in_doubles else "decimal(38,0)")
        return F.sum(value).alias(f"s{i}")

    sums = state.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.max("upper").alias("radius"), *[part(i) for i in range(size)]
    )
    after, radius = centres.copy(), np.zeros(len(centres))
    for row in sums.collect():
        after[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(size)]
        radius[row["cluster"]] = row["radius"] * (1 + SLACK)
    return after, moved(centres, after, radius)


def _described(state: DataFrame, centres: np.ndarray, id_column: str) -> DataFrame:
    spark = state.sparkSession
    sums = state.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    )
    found = {r["cluster"]: (r["n"], int(r["total"])) for r in sums.collect()}
    inertia = sum(total for _, total in found.values())
    rows = [(c, n, total, inertia, centres[c].tolist()) for c, (n, total) in sorted(found.items())]
    names = "cluster int, cluster_size bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    return state.join(F.broadcast(spark.createDataFrame(rows, names)), "cluster").select(
        F.col("id").alias(id_column), *_RESULT
    )
