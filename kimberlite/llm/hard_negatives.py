"""Hard negatives of anchors by lists that the anchors of a cluster share.

Anchors are clustered by direction. Seen from a cluster's centre, a candidate's
angle less the widest angle of the cluster's anchors bounds its inner product
with each of them; candidates sorted by that bound, once for the cluster, are a
list that all its anchors walk. An anchor stops where the bound of the next
candidate, times its own length, is below the lowest score it still needs: what
follows is certified not to matter.

Candidates lie in blocks, dealt by hash, and a block's lists are made where it
lies. A first part of the blocks gives each anchor scores that the walks through
all others start from. Anchors are read in parts, so that neither side of a
comparison is held whole. Of rows with equal vectors and labels only as many as
can be among the first are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kimberlite.llm.rows import runs
from kimberlite.llm.staged import result
from kimberlite.llm.whole_vectors import EXACT, finite, matrix, whole, widest, within
from kimberlite.sources.scratch import stage

#: Anchors of a cluster on average, clusters at most, anchors that fit their centres.
CLUSTER_ANCHORS, MOST_CLUSTERS, MOST_SAMPLED = 256, 4096, 16_384
#: Anchors that walk together, candidates of one step, candidates of a block.
MEMBERS, STEP, LEAST_BLOCK, MOST_BLOCK = 1024, 1024, 2048, 131_072
SLACK = 1e-9
_NONE = -(2**62)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    scale: int = 256,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Each component x becomes ``floor(scale * x)``; a score is the inner product
    of two rows, exactly. Higher scores come first, equal ones by smaller id. The
    rows for which ``anchor`` holds are anchors. An anchor's positives are its
    first other rows of the same label; for each positive the first rows of other
    labels are returned whose score is at most the positive's and at least
    ``least_percent`` of it, ranked from 1. A positive without such rows (all
    with a negative score, for one) gives none.

    Rows without an id, label or vector, with a component that is null or not
    finite, or of another length than most (equally many: the shorter) take no
    part, nor do components whose products exceed 64 bits (from ``2**24 / scale``
    up in 256 dimensions). Rows equal in id, label and vector count once; rows
    that share only their id are rows of their own, never compared with an anchor
    of that id. Other columns are not read. An empty table gives an empty result.
    """
    spark = vectors.sparkSession

    def make() -> DataFrame:
        plain = vectors.select(
            F.col(id_column).alias("id"),
            F.col(label_column).alias("label"),
            F.col(vector_column).alias("vector"),
            F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
        ).filter("id is not null and label is not null and vector is not null")
        lengths = plain.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
        size = lengths["n"] if lengths else 0
        good = finite("vector") & (F.size("vector") == size)
        good = F.when(good, within("vector", scale, widest(size, 56))).otherwise(False)
        fit = plain.withColumn("good", good).filter("good").withColumn("v", whole("vector", scale))
        told_apart = ["id", "label", F.xxhash64("v").alias("key_1"), F.xxhash64(F.lit(1), "v").alias("key_2")]
        rows = stage(
            fit.select(*told_apart, "v", "is_anchor")
            .groupBy("id", "label", "key_1", "key_2")
            .agg(F.first("v").alias("v"), F.max("is_anchor").alias("is_anchor")),
            "rows",
        )
        copies = Window.partitionBy("label", "key_1", "key_2").orderBy("id")
        most = max(positives, negatives) + 1  # one may have the anchor's id
        candidates = stage(
            rows.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= most).select("id", "label", "v"),
            "candidates",
        )
        search = _Search.over(rows, candidates, size)
        if search is None:
            kind = rows.schema["id"].dataType.simpleString()
            return spark.createDataFrame(
                [], f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind},"
                "positive_score bigint, negative_score bigint"
            )
        first = search.walked(search.members.withColumn("wanted", _without()), positives, None)
        place = Window.partitionBy("key").orderBy(F.desc("score"), "other_id")
        chosen = first.withColumn("place", F.row_number().over(place) - 1)
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda x: x["score"])
        wanted = chosen.groupBy("key").agg(ordered.alias("wanted"))
        found = search.walked(search.members.join(wanted, "key"), negatives, least_percent)
        named = chosen.select(
            "key", "place", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")
        )
        rank = Window.partitionBy("key", "place").orderBy(F.desc("score"), "other_id")
        return found.join(named, ["key", "place"]).select(
            F.col("id").alias("anchor_id"),
            "positive_id",
            F.row_number().over(rank).alias("rank"),
            F.col("other_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )

    return result(spark, make)


@dataclass
class _Search:
    """Anchors in clusters, candidates in blocks."""

    members: DataFrame
    candidates: DataFrame
    centres: np.ndarray
    widest_angle: np.ndarray
    blocks: int
    size: int
    in_doubles: bool

    @classmethod
    def over(cls, rows: DataFrame, candidates: DataFrame, size: int) -> _Search | None:
        spark = rows.sparkSession
        anchors = rows.filter("is_anchor").select(
            F.xxhash64("id", "label", "key_1", "key_2").alias("key"), "id", "label", "v"
        )
        n, n_anchors = candidates.count(), anchors.count()
        if not n_anchors:
            return None
        largest = candidates.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0
        in_doubles = size * 100 * int(largest) ** 2 < EXACT
        drawn = anchors.orderBy("key").limit(MOST_SAMPLED).select("v").toArrow().column("v")
        wanted = min(MOST_CLUSTERS, math.ceil(n_anchors / CLUSTER_ANCHORS))
        centres = _directions(_unit(matrix(drawn, size, True)), wanted)
        members = stage(_clustered(anchors, centres, size), "members")
        clusters = members.groupBy("cluster").agg(
            F.max("angle").alias("angle"), F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("parts")
        )
        widest_angle = np.zeros(len(centres))
        parts = []
        for row in clusters.collect():  # MOST_CLUSTERS rows at most
            widest_angle[row["cluster"]] = row["angle"]
            parts.append((row["cluster"], row["parts"]))
        split = F.broadcast(spark.createDataFrame(parts, "cluster int, parts int"))
        members = members.join(split, "cluster").withColumn("part", F.pmod("key", F.col("parts")).cast("int"))
        block = min(max(n // (4 * spark.sparkContext.defaultParallelism), LEAST_BLOCK), MOST_BLOCK)
        blocks = max(1, round(n / block))
        return cls(members, candidates, centres, widest_angle, blocks, size, in_doubles)

    def walked(self, members: DataFrame, k: int, least_percent: int | None) -> DataFrame:
        """``(key, id, place, other_id, score)``: the first ``k`` of each anchor (and place in ``wanted``)."""
        # The lowest scores that a first part of the blocks leaves to be found.
        first = math.ceil(self.blocks / 16)
        group = Window.partitionBy("key", "place").orderBy(F.desc("score"), "other_id")

        def best(found: DataFrame) -> DataFrame:
            return stage(
                found.withColumn("rank", F.row_number().over(group)).filter(F.col("rank") <= k).drop("rank"), "best"
            )

        begun = best(self._compared(members.withColumn("known", _without()), 0, first, k, least_percent))
        if first == self.blocks:
            return begun
        last = begun.groupBy("key", "place").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        full = last.filter(F.col("n") == k).groupBy("key")
        pairs = F.map_from_entries(F.collect_list(F.struct("place", "least")))
        places = F.sequence(F.lit(0), F.when(F.col("wanted").isNull(), 0).otherwise(F.size("wanted") - 1))
        known = F.when(F.col("places").isNotNull(), F.transform(places, lambda i: F.try_element_at("places", i)))
        members = members.join(full.agg(pairs.alias("places")), "key", "left").withColumn("known", known)
        rest = self._compared(members, first, self.blocks, k, least_percent)
        return best(rest.unionByName(begun))

    def _compared(self, members: DataFrame, begin: int, end: int, k: int, least_percent: int | None) -> DataFrame:
        block = F.pmod(F.xxhash64("id", "label"), F.lit(self.blocks)).cast("int")
        lying = self.candidates.withColumn("block", block).filter((F.col("block") >= begin) & (F.col("block") < end))
        lists = lying.select(
            "block",
            F.lit(-1).alias("cluster"),
            F.lit(0).alias("part"),
            "id",
            "label",
            "v",
            F.lit(None).cast("bigint").alias("key"),
            _without().alias("wanted"),
            _without().alias("known"),
        )
        coming = members.select(
            F.explode(F.sequence(F.lit(begin), F.lit(end - 1))).alias("block"),
            *[c for c in lists.columns if c != "block"],
        )
        order = ["block", "cluster", "part"]
        met = lists.unionByName(coming).repartition(end - begin, "block").sortWithinPartitions(*order, "id")
        search = (self.centres, self.widest_angle, self.size, self.in_doubles)

        def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            for run in runs(batches, order):
                if run.column("cluster")[0].as_py() < 0:
                    held = _Block.of(run, *search)
                elif held is not None and held.number == run.column("block")[0].as_py():
                    yield from held.walk(run, k, least_percent)

        kind = self.candidates.schema["id"].dataType.simpleString()
        return met.mapInArrow(walk, f"key bigint, id {kind}, place int, other_id {kind}, score bigint")


def _without() -> Column:
    return F.lit(None).cast("array<bigint>")


def _unit(points: np.ndarray) -> np.ndarray:
    length = np.sqrt((points**2).sum(axis=1, keepdims=True))
    return np.divide(points, length, out=np.zeros_like(points), where=length > 0)


def _directions(units: np.ndarray, n: int, turns: int = 10) -> np.ndarray:
    """Centres of ``n`` clusters of directions, from evenly spread ones; each of length one or zero."""
    centres = units[np.linspace(0, len(units) - 1, min(n, len(units))).astype(int)].copy()
    for _ in range(turns):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        centres = np.where((np.abs(sums).sum(axis=1) > 0)[:, None], _unit(sums), centres)
    return centres


def _clustered(anchors: DataFrame, centres: np.ndarray, size: int) -> DataFrame:
    """Anchors with the number of the nearest centre and the angle to it."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            units = _unit(matrix(batch.column("v"), size, True))
            cosine = units @ centres.T
            cluster = cosine.argmax(axis=1)
            angle = np.arccos(np.clip(cosine[np.arange(len(units)), cluster], -1, 1))
            angle[~units.any(axis=1)] = 0.0  # scores of a vector of length zero are all zero
            columns = [*batch.columns, pa.array(cluster, pa.int32()), pa.array(angle)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "cluster", "angle"])

    kinds = {f.name: f.dataType.simpleString() for f in anchors.schema}
    return anchors.mapInArrow(
        place, ", ".join(f"{n} {t}" for n, t in kinds.items()) + ", cluster int, angle double"
    )


@dataclass
class _Block:
    """Candidates in ascending order of ids."""

    number: int
    ids: pa.Array
    id_kinds: pa.Array
    id_code: np.ndarray
    label_kinds: pa.Array
    label_code: np.ndarray
    vectors: np.ndarray
    lengths: np.ndarray
    units: np.ndarray
    centres: np.ndarray
    widest_angle: np.ndarray
    in_doubles: bool
    places: int  # a power of two above the number of candidates

    @classmethod
    def of(cls, run: pa.Table, centres: np.ndarray, widest_angle: np.ndarray, size: int, in_doubles: bool) -> _Block:
        ids, labels = run.column("id").combine_chunks(), run.column("label").combine_chunks()
        id_kinds, label_kinds = ids.unique(), labels.unique()
        vectors = matrix(run.column("v"), size, in_doubles)
        points = vectors.astype(np.float64)
        lengths = np.sqrt((points**2).sum(axis=1))
        return cls(
            run.column("block")[0].as_py(),
            ids,
            id_kinds,
            _codes(ids, id_kinds),
            label_kinds,
            _codes(labels, label_kinds),
            vectors,
            lengths,
            _unit(points),
            centres,
            widest_angle,
            in_doubles,
            1 << len(ids).bit_length(),
        )

    def shared_list(self, cluster: int) -> tuple[np.ndarray, np.ndarray]:
        """Candidates by falling bound of their score with an anchor of length one, and these bounds."""
        angle = np.arccos(np.clip(self.units @ self.centres[cluster], -1, 1))
        nearest = np.maximum(angle - self.widest_angle[cluster] - SLACK, 0.0)
        bound = self.lengths * (np.cos(nearest) + SLACK)
        order = np.argsort(-bound, kind="stable")
        return order, bound[order]

    def walk(self, run: pa.Table, k: int, least_percent: int | None) -> Iterator[pa.RecordBatch]:
        """The first ``k`` candidates of each anchor: of its label, or for each wanted score those not above it."""
        order, bound = self.shared_list(run.column("cluster")[0].as_py())
        anchors = matrix(run.column("v"), self.vectors.shape[1], self.in_doubles)
        lengths = np.sqrt((anchors.astype(np.float64) ** 2).sum(axis=1))
        label = _codes(run.column("label").combine_chunks(), self.label_kinds)
        own = _codes(run.column("id").combine_chunks(), self.id_kinds)
        same = least_percent is None
        wanted = [[None]] * len(anchors) if same else run.column("wanted").to_pylist()
        width = max(map(len, wanted))
        number = np.float64 if self.in_doubles else object
        high = np.zeros((len(anchors), width), number)
        low = np.full((len(anchors), width), np.inf, number)
        known = np.full((len(anchors), width), -np.inf, number)
        for i, (scores, least) in enumerate(zip(wanted, run.column("known").to_pylist())):
            for j, score in enumerate(scores):
                if same:
                    high[i, j], low[i, j] = np.inf, -np.inf
                elif score >= 0:
                    high[i, j], low[i, j] = score, -(-least_percent * score // 100)
                if least and least[j] is not None:
                    known[i, j] = least[j]
        low = np.maximum(low, known)
        kind = np.int64 if self._packs(anchors) else object
        best = np.full((len(anchors), width, k), _NONE, kind)
        need = low.min(axis=1).astype(np.float64)
        walking = np.arange(len(anchors))
        for begin in range(0, len(order), STEP):
            reach = bound[begin] * lengths[walking]
            walking = walking[reach + SLACK * (1 + np.abs(reach)) >= need[walking]]
            if not len(walking):
                break
            there = order[begin : begin + STEP]
            score = anchors[walking] @ self.vectors[there].T
            fits = (self.label_code[there][None, :] == label[walking][:, None]) == same
            fits &= self.id_code[there][None, :] != own[walking][:, None]
            # Score first, then the smaller id.
            packed = score.astype(kind) * self.places + (self.places - 1 - there).astype(kind)[None, :]
            for j in range(width):
                within = fits & (score >= low[walking, j][:, None]) & (score <= high[walking, j][:, None])
                if within.any():
                    both = np.concatenate([best[walking, j], np.where(within, packed, _NONE)], axis=1)
                    best[walking, j] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            least = best[walking].min(axis=2)
            reached = np.where(least > _NONE, least // self.places, low[walking])
            need[walking] = np.maximum(reached, low[walking]).min(axis=1).astype(np.float64)
        i, j, _ = found = np.nonzero(best > _NONE)
        if len(i):
            at = best[found]
            yield pa.RecordBatch.from_arrays(
                [
                    run.column("key").combine_chunks().take(pa.array(i)),
                    run.column("id").combine_chunks().take(pa.array(i)),
                    pa.array(j, pa.int32()),
                    self.ids.take(pa.array((self.places - 1 - at % self.places).astype(np.int64))),
                    pa.array((at // self.places).astype(np.int64)),
                ],
                names=["key", "id", "place", "other_id", "score"],
            )

    def _packs(self, anchors: np.ndarray) -> bool:
        """Whether a score and a place fit one 64-bit integer."""
        most = float(self.lengths.max()) * float(np.abs(anchors.astype(np.float64)).max()) * anchors.shape[1]
        return (most + 1) * self.places < 2**61


def _codes(values: pa.Array, kinds: pa.Array) -> np.ndarray:
    """Place of each value among ``kinds``, -1 if it is none."""
    return pc.fill_null(pc.index_in(values, value_set=kinds), -1).to_numpy(zero_copy_only=False)

