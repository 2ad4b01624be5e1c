"""Near-duplicate documents by SuperMinHash, banding, verification and union-find.

Documents with equal shingle sets form a class; one of each class goes on. Its
signature is cut into bands, and documents that share a band meet in a bucket.
Verification is on the full shingle sets. A bucket is worked in two turns:

1. Every document of a bucket is compared with the bucket's smallest id, so a
   bucket of n gives n - 1 pairs. Verified links are joined into components.
2. In buckets that still hold several components, documents are dealt into
   blocks and blocks compared with blocks, each pair of blocks a group of its
   own. Documents whose signatures agree often enough with one of another
   component meet again with their sets, and the links that join components are
   given out; pairs are not. One pair is worked on in one bucket only.

No bucket is cut or skipped and no group meets in one task. A link is missed
only if no band agrees or the signatures agree far less than the sets do; at the
default 48 bands of 6, with a similarity of 0.8, that happens to fewer than one
link in a million, and only matters where no other link joins the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kimberlite.llm.graph import components
from kimberlite.llm.row_keys import told_apart
from kimberlite.llm.rows import runs
from kimberlite.llm.staged import broadcast_if_few, result
from kimberlite.llm.superminhash import band_keys, signatures
from kimberlite.llm.words import BLANK_SEPARATED, blocks, grams, mix, starts_inside, words_of
from kimberlite.sources.scratch import stage

#: Documents of a bucket that are compared at once in the second turn.
BLOCK_ROWS = 256
#: Standard deviations by which an estimate may stay below the similarity.
_DEVIATIONS = 5.0


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    places: int = 288,
    bands: int = 48,
) -> DataFrame:
    """``(id, text_hash, n_shingles, component_id, kept)`` for every row of ``docs``.

    Words are runs of characters other than blanks, A-Z lowered. The set holds
    the distinct runs of ``shingle_words`` words; of a shorter text, all words as
    one; of a text that is null or has no words, nothing. Two documents are
    linked if 100 * intersection >= ``percent`` * union; ``component_id`` is the
    smallest id reachable over links, ``kept`` says that it is the row's own.

    Empty sets link with nothing. A row without an id gets a null component and
    is kept. Rows that repeat an id are each judged by their own text; equal rows
    get equal results. Other columns of ``docs`` are not read. Very long texts
    are processed whole. An empty table gives an empty result.
    """

    def make() -> DataFrame:
        texts = told_apart(docs, id_column, text_column)
        sketched = stage(_sketched(texts, shingle_words, places, bands), "sketched")
        members = sketched.select("id", "text_hash", "n_shingles", "class_1", "class_2")
        classes = (
            members.filter("id is not null and n_shingles > 0")
            .groupBy("class_1", "class_2")
            .agg(F.min("id").alias("head"), F.max("id").alias("last"))
        )
        heads = classes.select(F.col("head").alias("id")).distinct()
        sketches = stage(
            sketched.filter("n_shingles > 0")
            .join(heads, "id", "left_semi")
            .select("id", "n_shingles", "keys", "signature"),
            "sketches",
        )
        links = _links(texts, sketches, shingle_words, percent, places)
        joined = components(links)
        several = classes.filter("head < last").select("class_1", "class_2", "head")
        placed = members.join(several, ["class_1", "class_2"], "left").withColumn(
            "node", F.coalesce("head", "id")
        )
        labelled = placed.join(joined, "node", "left").select(
            F.col("id").alias(id_column),
            "text_hash",
            "n_shingles",
            F.coalesce("component", "node").alias("component_id"),
        )
        own = F.col(id_column).isNull() | (F.col(id_column) == F.col("component_id"))
        return labelled.withColumn("kept", own)

    return result(docs.sparkSession, make)


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, ascending within a text, and their number."""
    words = words_of(texts, BLANK_SEPARATED)
    inside = starts_inside(words, n)
    values, row = grams(words.hash, n)[inside], words.doc[: len(inside)][inside]
    counts = np.diff(words.first)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = [grams(words.hash[words.first[i] : words.first[i + 1]], counts[i])[0] for i in short]
        values, row = np.append(values, np.array(whole, np.uint64)), np.append(row, short)
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[new], np.bincount(row[new], minlength=len(texts))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    ends = np.cumsum(sizes)
    return (total[ends] - total[ends - sizes]).view(np.int64)


def _sketched(texts: DataFrame, n: int, places: int, bands: int) -> DataFrame:
    """Set size, a 128-bit digest of the set, band keys and the signature's low bytes."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begun, some in blocks(batch.column("text")):
                values, sizes = shingle_sets(some, n)
                signature = signatures(values, sizes, places)
                keys = band_keys(signature, bands).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(begun, len(some)),
                        batch.column("text_hash").slice(begun, len(some)),
                        pa.array(sizes, pa.int64()),
                        pa.array(_sums(mix(values), sizes)),
                        pa.array(_sums(mix(values ^ np.uint64(0xA24BAED4963EE407)), sizes)),
                        pa.ListArray.from_arrays(
                            np.arange(len(some) + 1, dtype=np.int32) * bands, keys.ravel()
                        ),
                        pa.array([row.tobytes() for row in signature.astype(np.uint8)], pa.binary()),
                    ],
                    names=["id", "text_hash", "n_shingles", "class_1", "class_2", "keys", "signature"],
                )

    return texts.mapInArrow(
        sketch,
        "id bigint, text_hash bigint, n_shingles bigint, class_1 bigint, class_2 bigint, "
        "keys array<bigint>, signature binary",
    )


def _links(texts: DataFrame, sketches: DataFrame, n: int, percent: int, places: int) -> DataFrame:
    rows = sketches.select(F.explode("keys").alias("key"), "id")
    shared = stage(
        rows.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last"),
        "buckets",
    )
    buckets = stage(rows.join(shared.select("key", "first"), "key"), "members")
    stars = stage(
        buckets.filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct(),
        "stars",
    )
    first_links = stage(_verified(texts, stars, n, percent), "links")
    known = components(first_links).withColumnRenamed("node", "id")
    labelled = buckets.join(known, "id", "left").select(
        "key", "first", "id", F.coalesce("component", "id").alias("component")
    )
    mixed = (
        labelled.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high and n > 2")  # of two, the first turn has compared all
        .select("key", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("n_blocks"))
    )
    return first_links.unionByName(_across(texts, labelled.join(mixed, "key"), sketches, n, percent, places))


def _across(
    texts: DataFrame, buckets: DataFrame, sketches: DataFrame, n: int, percent: int, places: int
) -> DataFrame:
    """Links between different components of a bucket, without those to its first document."""
    dealt = buckets.withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int"))
    partner = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    met = dealt.withColumn("partner", partner).select(
        "key",
        F.least("block", "partner").alias("low"),
        F.greatest("block", "partner").alias("high"),
        "block",
        "id",
        "component",
        "first",
    )
    similarity = percent / 100
    slack = _DEVIATIONS * (similarity * (1 - similarity) / places) ** 0.5
    least = int(np.floor((similarity - slack) * places))
    group = ["key", "low", "high"]
    rows = [*group, "block", "id", "component", "first", "n_shingles", "keys", "signature"]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a group that may have a link in it."""
        for run in runs(batches, group):
            found = [np.append(other, i) for i, other in _candidates(run, percent, least) if len(other)]
            if found:
                yield from run.select(rows).take(np.unique(np.concatenate(found))).to_batches()

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links that join components of a group, enough of them to join all that are linked."""
        for run in runs(batches, group):
            ids, component = run.column("id").to_numpy(), run.column("component").to_pylist()
            sets = [np.frombuffer(v.as_py(), np.uint64) for v in run.column("held")]
            joined = {c: c for c in component}

            def root(c: int) -> int:
                while joined[c] != c:
                    c = joined[c]
                return c

            links = []
            for i, other in _candidates(run, percent, least):
                for j in other.tolist():
                    one, two = root(component[i]), root(component[j])
                    if one != two and similar(sets[i], sets[j], percent):
                        joined[max(one, two)] = min(one, two)
                        links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
            if links:
                a, b = map(np.array, zip(*links))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def dealt_out(df: DataFrame) -> DataFrame:
        return df.repartition(*group).sortWithinPartitions(*group)

    kinds = (
        "key bigint, low int, high int, block int, id bigint, component bigint, first bigint, "
        "n_shingles bigint, keys array<bigint>, signature binary"
    )
    close = stage(dealt_out(met.join(sketches, "id")).mapInArrow(near, kinds), "close")
    held = _sets(texts, close.select("id").distinct(), n).withColumnRenamed("id", "held_id")
    complete = close.join(held, F.col("id") == F.col("held_id"))
    return dealt_out(complete).mapInArrow(confirm, "a bigint, b bigint").distinct()


def _candidates(run: pa.Table, percent: int, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row, the later ones of another component that may be similar enough."""
    key, first = run.column("key")[0].as_py(), run.column("first")[0].as_py()
    ids, component, size, block = (run.column(c).to_numpy() for c in ("id", "component", "n_shingles", "block"))
    signature = np.frombuffer(b"".join(run.column("signature").to_pylist()), np.uint8).reshape(len(ids), -1)
    keys = run.column("keys").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    low = run.column("low")[0].as_py() == block
    own = run.column("low")[0].as_py() == run.column("high")[0].as_py()
    left = np.flatnonzero(low & (ids != first))
    right = np.flatnonzero((low if own else ~low) & (ids != first))
    for i in left:
        other = right[(component[right] != component[i]) & ((ids[right] > ids[i]) | (not own))]
        small, large = np.minimum(size[other], size[i]), np.maximum(size[other], size[i])
        other = other[100 * small >= percent * large]
        other = other[(signature[other] == signature[i]).sum(axis=1) >= least]
        # The first band that both share works on the pair.
        yield i, other[keys[i][(keys[other] == keys[i]).argmax(axis=1)] == key]


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two sets of distinct values are linked."""
    common = len(np.intersect1d(one, two, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(one) + len(two) - common)


def _sets(texts: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """The shingle sets of the documents with the ``wanted`` ids."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begun, some in blocks(batch.column("text")):
                values, sizes = shingle_sets(some, n)
                ends = np.cumsum(sizes)
                held = [values[e - s : e].tobytes() for s, e in zip(sizes, ends)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(begun, len(some)), pa.array(held, pa.binary())],
                    names=["id", "held"],
                )

    few = broadcast_if_few(stage(wanted, "wanted"))
    return stage(texts.join(few, "id", "left_semi").mapInArrow(sets, "id bigint, held binary"), "sets")


def _verified(texts: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    held = _sets(texts, wanted, n)
    one = held.select(F.col("id").alias("a"), F.col("held").alias("held_a"))
    two = held.select(F.col("id").alias("b"), F.col("held").alias("held_b"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [
                [np.frombuffer(v.as_py(), np.uint64) for v in batch.column(c)] for c in ("held_a", "held_b")
            ]
            keep = [similar(p, q, percent) for p, q in zip(*sets)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    compared = pairs.join(one, "a").join(two, "b").select("a", "b", "held_a", "held_b")
    return compared.mapInArrow(confirm, "a bigint, b bigint").distinct()
