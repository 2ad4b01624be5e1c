"""Near-duplicate vectors by an inverted multi-index.

Two codebooks, one for each half of the vectors, are fitted on a bounded sample;
a cell is a pair of codewords, and every distinct vector lies in the cell of its
nearest two. A vector's search visits cells by growing distance, the sum of the
distances of both halves, following the two sorted lists of codewords without
forming the grid (multi-sequence). How many cells are visited is measured: a
sample of vectors is compared with all others, and the visits are as many as
reach the target recall on the pairs found. Where links are so rare that the
sample sees few, neighbours at the least cosine are made for it, and the visits
reach those too. In each cell the visiting vectors are compared with those that
lie there, in blocks, in double precision; a visitor is sent once to all cells
of one row of the grid.

Equal vectors are one from the start. Pairs are counted where they are found and
not given out: a block returns how many links each vector has and only so many
of them as join what is linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kimberlite.llm.graph import components
from kimberlite.llm.rows import runs
from kimberlite.llm.staged import result
from kimberlite.operators.numbering import number_rows
from kimberlite.operators.ordering import ascending
from kimberlite.sources.scratch import stage

#: Vectors that lie in a cell on average.
CELL_VECTORS = 32
#: Codewords of a half at most; cells are larger beyond CELL_VECTORS * 4096**2 vectors.
MOST_CODEWORDS = 4096
#: Times the visits that the probes need: they see few of the pairs that lie far apart.
MARGIN = 2
#: Vectors of a row of the grid, and visitors, that meet in one group.
MEMBER_BLOCK, VISITOR_BLOCK = 4096, 8192
#: Pairs that the probes must see for the visits to rest on them alone.
ENOUGH_SEEN = 1000
#: Share of the made neighbours that the visits reach, from one side or the other.
MADE_RECALL = 0.995


@dataclass
class Index:
    """Codebooks of both halves and the number of cells a search visits."""

    left: np.ndarray
    right: np.ndarray
    visits: int = 1

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.left.shape[1]
        return _squared(unit[:, :half], self.left), _squared(unit[:, half:], self.right)

    def cell(self, unit: np.ndarray) -> np.ndarray:
        left, right = self.distances(unit)
        return left.argmin(axis=1) * len(self.right) + right.argmin(axis=1)

    def nearest_cells(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Numbers of each vector's nearest cells, the nearest first, from its distances to the codewords.

        The cell of the i-th and j-th nearest codewords comes after the i * j that
        are nearer in both halves or one, so only those with i * j up to the number
        of visits are looked at.
        """
        rows, columns = np.argsort(left, axis=1, kind="stable"), np.argsort(right, axis=1, kind="stable")
        a, b = np.take_along_axis(left, rows, axis=1), np.take_along_axis(right, columns, axis=1)
        visits = min(self.visits, a.shape[1] * b.shape[1])
        reach = np.minimum(visits // np.arange(1, min(a.shape[1], visits) + 1), b.shape[1])
        i = np.repeat(np.arange(len(reach)), reach)
        j = np.arange(len(i)) - np.repeat(np.cumsum(reach) - reach, reach)
        out = np.empty((len(a), visits), np.int64)
        step = max(1, (1 << 21) // len(i))
        for k in range(0, len(a), step):
            some = slice(k, k + step)
            order = np.argsort(a[some][:, i] + b[some][:, j], axis=1, kind="stable")[:, :visits]
            out[some] = np.take_along_axis(rows[some], i[order], axis=1) * b.shape[1]
            out[some] += np.take_along_axis(columns[some], j[order], axis=1)
        return out

    def rank(self, left: np.ndarray, right: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """At which visit each vector comes to its ``cell``."""
        i, j = np.divmod(cell, len(self.right))
        rows = np.arange(len(cell))
        distance = left[rows, i] + right[rows, j]
        sorted_right = np.sort(right, axis=1)
        # Nearer cells, counted along the left codewords.
        nearer = [np.searchsorted(r, d - a, side="left").sum() for r, d, a in zip(sorted_right, distance, left)]
        return np.array(nearer, np.int64) + 1


def _squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]


def _codebook(points: np.ndarray, n: int, turns: int = 12) -> np.ndarray:
    """Lloyd's algorithm from evenly spread points; an empty codeword keeps its place."""
    centres = points[np.linspace(0, len(points) - 1, n).astype(int)].copy()
    for _ in range(turns):
        nearest = _squared(points, centres).argmin(axis=1)
        count = np.bincount(nearest, minlength=n)
        for i in range(points.shape[1]):
            sums = np.bincount(nearest, weights=points[:, i], minlength=n)
            centres[:, i] = np.where(count > 0, sums / np.maximum(count, 1), centres[:, i])
    return centres


def _units(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    """Vectors of an Arrow list column, in double precision and of length one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    values = values / np.abs(values).max(axis=1, keepdims=True, initial=0)  # no overflow in squares
    return values / np.sqrt((values**2).sum(axis=1, keepdims=True))


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    least_cosine: float = 0.9,
    target_recall: float = 1.0,
    most_sampled: int = 16_384,
    probes: int = 2048,
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row of ``vectors``.

    Two rows are linked if a search finds them and their cosine, in double
    precision, is at least ``least_cosine``. ``n_links`` counts the other rows
    linked with a row, ``component_id`` is the smallest id reachable over links,
    ``kept`` says that it is the row's own. Ids are of any type that has an order.

    Vectors that are null, zero, of another length than most, or have a component
    that is null or not finite link with nothing. Rows without an id link with
    nothing, get a null component and are kept. Rows that repeat an id are judged
    each by its own vector and count as rows. Other columns are not read. An
    empty table gives an empty result.

    At most ``most_sampled`` vectors, those with the smallest hash, fit
    the codebooks; ``probes`` of them measure the number of visits against all
    vectors. Every vector is indexed and searched.

    The visits grow with the number of vectors where links are rare and vectors
    lie evenly: of 60 000 random ones in 64 dimensions, a vector visits some
    hundred of 1849 cells.
    """
    spark = vectors.sparkSession

    def make() -> DataFrame:
        plain = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"))
        lengths = plain.filter("vector is not null").groupBy(F.size("vector").alias("n")).count()
        common = lengths.orderBy(F.desc("count"), "n").first()
        size = common["n"] if common else 0
        finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        good = (F.size("vector") == size) & finite & F.exists("vector", lambda x: x != 0) & F.col("id").isNotNull()
        good = F.coalesce(good, F.lit(False))
        rows = plain.select(
            "id",
            F.when(good, F.xxhash64("vector")).alias("key_1"),
            F.when(good, F.xxhash64(F.lit(1), "vector")).alias("key_2"),
            F.when(good, F.col("vector")).alias("vector"),
        )
        # One number for each different vector, in the order of their smallest ids.
        classes = number_rows(
            rows.filter("key_1 is not null")
            .groupBy("key_1", "key_2")
            .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")),
            ascending("id", "key_1", "key_2"),
            "node",
        )
        found = stage(_found(classes, size, least_cosine, target_recall, most_sampled, probes), "found")
        joined = components(found.filter("b is not null").select("a", "b"))
        least = classes.select(F.col("node").alias("component"), F.col("id").alias("component_id"))
        joined = joined.join(least, "component").select("node", "component_id")
        counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
        heads = (
            classes.select("key_1", "key_2", "node", "id", "copies")
            .join(counts, "node", "left")
            .join(joined, "node", "left")
            .select(
                "key_1",
                "key_2",
                (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component_id", "id").alias("component_id"),
            )
        )
        labelled = rows.drop("vector").join(heads, ["key_1", "key_2"], "left")
        component = F.coalesce("component_id", "id")
        return labelled.select(
            F.col("id").alias(id_column),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            component.alias("component_id"),
            (F.col("id").isNull() | (F.col("id") == component)).alias("kept"),
        )

    return result(spark, make)


def _found(
    classes: DataFrame, size: int, least_cosine: float, target_recall: float, most_sampled: int, probes: int
) -> DataFrame:
    """Numbers of links ``(a, null, n)`` and joining links ``(a, b, 0)``."""
    spark = classes.sparkSession
    n = classes.count()
    by_hash = [F.xxhash64("key_1", "key_2"), "node"]
    drawn = classes.select("node", "vector", "key_1", "key_2").orderBy(*by_hash).limit(most_sampled).toArrow()
    if not n:
        return spark.createDataFrame([], "a bigint, b bigint, n bigint")
    sample = _units(drawn.column("vector"), size)
    codewords = int(min(max(1, round((n / CELL_VECTORS) ** 0.5)), MOST_CODEWORDS, len(sample)))
    half = max(1, size // 2)
    index = Index(_codebook(sample[:, :half], codewords), _codebook(sample[:, half:], codewords))
    index.visits = _visits(classes, index, size, sample[:probes], least_cosine, target_recall)
    held = spark.sparkContext.broadcast(index)  # at most 2 * MOST_CODEWORDS codewords

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _units(batch.column("vector"), size)
            cells = index.nearest_cells(*index.distances(unit)).astype(np.int32)
            # The visited cells of each row of the grid together.
            in_rows = np.sort(cells, axis=1)
            new = np.ones(in_rows.shape, bool)
            new[:, 1:] = np.diff(in_rows // len(index.right), axis=1) > 0
            first = np.flatnonzero(new)
            want = pa.ListArray.from_arrays(pa.array(np.r_[first, new.size].astype(np.int32)), pa.array(in_rows.ravel()))
            at = pa.array((in_rows.ravel()[first] // len(index.right)).astype(np.int32))
            counts = np.r_[0, np.cumsum(new.sum(axis=1))].astype(np.int32)
            visits = np.arange(len(cells) + 1, dtype=np.int32) * cells.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    batch.column("copies"),
                    batch.column("vector"),
                    pa.array(cells[:, 0]),
                    pa.ListArray.from_arrays(pa.array(visits), pa.array(in_rows.ravel())),
                    pa.ListArray.from_arrays(pa.array(counts), pa.StructArray.from_arrays([at, want], ["at", "want"])),
                ],
                names=["node", "copies", "vector", "cell", "visits", "spots"],
            )

    kind = classes.schema["vector"].dataType.simpleString()
    spots = "spots array<struct<at:int,want:array<int>>>"
    out = f"node bigint, copies bigint, vector {kind}, cell int, visits array<int>, {spots}"
    indexed = stage(classes.select("node", "copies", "vector").mapInArrow(place, out), "indexed")
    return _compared(indexed, size, least_cosine, len(index.right))


def _visits(
    classes: DataFrame, index: Index, size: int, probes: np.ndarray, least_cosine: float, target_recall: float
) -> int:
    """Cells to visit so that the probes find ``target_recall`` of what a full comparison finds."""
    held = classes.sparkSession.sparkContext.broadcast((index, probes))

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, probes = held.value
        left, right = index.distances(probes)
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _units(batch.column("vector"), size)
            cosine = probes @ unit.T
            probe, other = np.nonzero((cosine >= least_cosine) & (cosine < 1 - 1e-12))
            rank = index.rank(left[probe], right[probe], index.cell(unit[other])) if len(other) else []
            kinds, count = np.unique(np.array(rank, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(count)], names=["rank", "n"])

    rows = classes.select("vector").mapInArrow(ranks, "rank bigint, n bigint").groupBy("rank").agg(F.sum("n").alias("n"))
    # As many rows as there are different ranks at most, and no more than pairs found.
    total = stage(rows, "ranks")
    every = total.agg(F.sum("n")).first()[0] or 0
    visits = 1
    if every:
        ranked = total.orderBy("rank").collect()
        seen = np.cumsum([r["n"] for r in ranked])
        visits = MARGIN * int(ranked[int(np.searchsorted(seen, target_recall * every))]["rank"])
    if every < ENOUGH_SEEN:
        visits = max(visits, _visits_to_made(index, probes, least_cosine))
    return visits


def _visits_to_made(index: Index, probes: np.ndarray, least_cosine: float) -> int:
    """Cells to visit so that nearly all neighbours made at the least cosine are found from one side."""
    rng = np.random.default_rng(len(probes))
    aside = rng.normal(size=probes.shape)
    aside -= (aside * probes).sum(axis=1, keepdims=True) * probes
    aside /= np.maximum(np.sqrt((aside**2).sum(axis=1, keepdims=True)), 1e-300)
    made = least_cosine * probes + (1 - least_cosine**2) ** 0.5 * aside
    there = index.rank(*index.distances(probes), index.cell(made))
    back = index.rank(*index.distances(made), index.cell(probes))
    return int(np.ceil(np.quantile(np.minimum(there, back), MADE_RECALL)))


def _compared(indexed: DataFrame, size: int, least_cosine: float, columns: int) -> DataFrame:
    row = F.floor(F.col("cell") / columns).cast("int")
    lying = indexed.groupBy(row.alias("at")).agg(
        F.ceil(F.count(F.lit(1)) / MEMBER_BLOCK).cast("int").alias("member_blocks")
    )
    visiting = indexed.select("node", "copies", "vector", "cell", F.inline("spots"))
    sizes = stage(
        visiting.groupBy("at")
        .agg(F.ceil(F.count(F.lit(1)) / VISITOR_BLOCK).cast("int").alias("visitor_blocks"))
        .join(lying, "at"),
        "rows_of_cells",
    )

    def block(n: str):
        return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    nothing = F.lit(None).cast("array<int>")
    visitors = (
        visiting.join(sizes, "at")
        .withColumn("visitor_block", block("visitor_blocks"))
        .withColumn("member_block", every("member_blocks"))
        .select("at", "member_block", "visitor_block", "node", "copies", "vector", "cell", "want", nothing.alias("visits"))
    )
    members = (
        indexed.withColumn("at", row)
        .join(sizes, "at")
        .withColumn("member_block", block("member_blocks"))
        .withColumn("visitor_block", every("visitor_blocks"))
        .select("at", "member_block", "visitor_block", "node", "copies", "vector", "cell", nothing.alias("want"), "visits")
    )
    group = ["at", "member_block", "visitor_block"]
    met = visitors.unionByName(members).repartition(*group).sortWithinPartitions(*group)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, group):
            lies = run.column("visits").combine_chunks().is_valid()
            there, coming = run.filter(lies), run.filter(pc.invert(lies))
            if not (there.num_rows and coming.num_rows):
                continue
            x, y = _units(coming.column("vector"), size), _units(there.column("vector"), size)
            x_id, y_id = coming.column("node").to_numpy(), there.column("node").to_numpy()
            x_cell, y_cell = coming.column("cell").to_numpy(), there.column("cell").to_numpy()
            i, j = _near(x, y, y_cell, coming.column("want").combine_chunks(), least_cosine)
            # A pair that each would find from its own side counts where the smaller number visits.
            later = np.flatnonzero(x_id[i] > y_id[j])
            if len(later):
                visited = there.column("visits").combine_chunks()
                owner = np.repeat(np.arange(len(y)), visited.value_lengths().to_numpy())
                cells = int(max(x_cell.max(), visited.flatten().to_numpy().max())) + 1
                back = np.isin(j[later] * cells + x_cell[i[later]], owner * cells + visited.flatten().to_numpy())
                later = later[back]
            keep = x_id[i] != y_id[j]
            keep[later] = False
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            x_n, y_n = coming.column("copies").to_numpy(), there.column("copies").to_numpy()
            ids = np.concatenate([x_id[i], y_id[j]])
            kinds, at = np.unique(ids, return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([y_n[j], x_n[i]]), minlength=len(kinds)).astype(np.int64)
            a, b = _joining(at[: len(i)], at[len(i) :], kinds)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([kinds, a])),
                    pa.array([None] * len(kinds) + b.tolist(), pa.int64()),
                    pa.array(np.concatenate([n, np.zeros(len(a), np.int64)])),
                ],
                names=["a", "b", "n"],
            )

    return met.mapInArrow(compare, "a bigint, b bigint, n bigint")


def _near(
    x: np.ndarray, y: np.ndarray, y_cell: np.ndarray, want: pa.ListArray, least_cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a visitor and a vector near it that lies in a cell it wants."""
    visitor = np.repeat(np.arange(len(x)), want.value_lengths().to_numpy())
    cell = want.flatten().to_numpy()
    by_cell, lying = np.argsort(cell, kind="stable"), np.argsort(y_cell, kind="stable")
    kinds = np.unique(y_cell)
    bounds = [np.searchsorted(c[o], kinds, side) for c, o in ((cell, by_cell), (y_cell, lying)) for side in ("left", "right")]
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for begin, end, first, last in zip(*bounds):
        mine = lying[first:last]
        for k in range(begin, end, 2048):
            coming = visitor[by_cell[k : min(k + 2048, end)]]
            i, j = np.nonzero(x[coming] @ y[mine].T >= least_cosine)
            found.append((coming[i], mine[j]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _joining(one: np.ndarray, two: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node of a small graph but the smallest of its component, an edge to that."""
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label[one], label[two])
        new = label.copy()
        np.minimum.at(new, one, least)
        np.minimum.at(new, two, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return ids[moved], ids[label[moved]]
