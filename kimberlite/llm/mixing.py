"""Mixing sources to target weights by Pareto order sampling.

A source with a target of f times its size gets floor(f) whole copies of each
document, which are certain, and a sample for the rest. Documents are ranked by
their random odds u / (1 - u) divided by the odds p / (1 - p) of their inclusion
probability, and the ranking is followed to its end: a document is taken if it
fits into the words still wanted. Each round takes what fits up to the first
document that overshoots and goes on with those that are no larger than the gap,
until none is. u is a hash of id and text, so reruns and other partitionings
choose alike.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kimberlite.llm.rows import runs
from kimberlite.llm.staged import result
from kimberlite.operators.numbering import number_rows
from kimberlite.sources.scratch import stage

WEIGHTS = (5, 2, 1)
#: Documents after one that overshoots that one task goes on with in a round; it saves rounds and limits nothing.
FILL_ROWS = 1000
_ODDS_LIMIT = 1e-6


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most_copies: int = 3,
    preference_column: str | None = None,
    seed: int = 1,
) -> DataFrame:
    """``(id, source, text_hash, size, source_size, target, copies)`` for every row of ``docs``.

    Size counts runs of characters other than blanks; null texts have none.
    Sources, by code point with null last, take ``weights`` in turn and share the
    total size by them. No target is above ``most_copies`` times its source's
    size; what is over is shared again by weight among the rest. ``copies`` is
    how often the mix takes a document, at most ``most_copies``. A preference
    (positive, 1 where null) scales the odds of a document within its source.

    Documents of no words may be chosen and change nothing. Rows without an id
    are told apart by their text; rows equal in id and text may get different
    copies, the same number of each in every run. An empty table gives an empty
    result; a source without words has target 0 and copies 0.
    """

    def make() -> DataFrame:
        text = F.coalesce(F.col(text_column), F.lit(""))
        prefer = F.col(preference_column).cast("double") if preference_column else F.lit(None).cast("double")
        sized = stage(
            docs.select(
                F.col(id_column).alias("id"),
                F.col(source_column).cast("string").alias("source"),
                # Sorts as the sources do, null last, and has no null.
                F.when(F.col(source_column).isNull(), "1")
                .otherwise(F.concat(F.lit("0"), F.col(source_column).cast("string")))
                .alias("at"),
                F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint").alias("size"),
                F.xxhash64(text_column).alias("text_hash"),
                F.xxhash64(F.lit(seed), F.col(id_column), text).alias("draw"),
                F.coalesce(prefer, F.lit(1.0)).alias("prefer"),
            ),
            "sized",
        )
        shares = stage(targets(sized.groupBy("at").agg(F.sum("size").alias("source_size")), weights, most_copies), "targets")
        ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
        # A hair below a whole number of copies is that number.
        whole = F.floor(ratio + 1e-9)
        rows = sized.join(shares, "at").withColumns(
            {"whole": whole, "wanted": F.greatest(F.lit(0.0), F.col("target") - whole * F.col("source_size"))}
        )
        chosen = _sampled(rows)
        return chosen.select(
            F.col("id").alias(id_column),
            F.col("source").alias(source_column),
            "text_hash",
            "size",
            "source_size",
            "target",
            (F.col("whole") + F.col("extra")).cast("bigint").alias("copies"),
        )

    return result(docs.sparkSession, make)


def targets(sizes: DataFrame, weights: Sequence[float], most_copies: float) -> DataFrame:
    """Add ``target`` to ``(at, source_size)``, one row per source."""
    numbered = number_rows(sizes, [F.col("at").asc()], "place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    placed = stage(
        numbered.select(
            "at",
            "source_size",
            (F.col("source_size") * most_copies).cast("double").alias("cap"),
            F.element_at(cycle, (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")).alias("weight"),
        ),
        "sources",
    )
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    # Per unit of weight; grows until no open source would be above its cap.
    level = None
    while True:
        full = F.lit(False) if level is None else F.col("cap") < F.col("weight") * F.lit(level)
        row = placed.agg(
            F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        taken, weight = row[0] or 0.0, row[1] or 0.0
        if not weight:
            break
        new = (total - taken) / weight
        if level is not None and new <= level:
            break
        level = new
    share = F.lit(0.0) if level is None else F.col("weight") * F.lit(level)
    return placed.select("at", "source_size", F.least("cap", share).alias("target"))


def _sampled(rows: DataFrame) -> DataFrame:
    """Add ``extra``, 1 where a document is sampled, so that the words come near ``wanted``."""
    u = (F.shiftrightunsigned("draw", 11) + 0.5) / F.lit(float(2**53))
    p = F.when(F.col("source_size") > 0, F.col("wanted") / F.col("source_size")).otherwise(0.0)
    odds = F.greatest(p, F.lit(_ODDS_LIMIT)) / F.greatest(1 - p, F.lit(_ODDS_LIMIT)) * F.col("prefer")
    ranked = rows.withColumn("rank", u / (1 - u) / odds)
    order = ["at", "rank", "draw", "id", "size"]
    placed = stage(
        ranked.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()),
        "ranked",
    )
    summed = _running(placed, order[1:])
    summed = stage(summed.withColumn("fits", (F.col("wanted") > 0) & (F.col("words") <= F.col("wanted"))), "summed")
    reached = summed.groupBy("at").agg(
        F.coalesce(F.max(F.when(F.col("fits"), F.col("words"))), F.lit(0)).alias("reached"),
        F.coalesce(F.max(F.when(F.col("fits"), F.col("n"))), F.lit(0)).alias("n_fit"),
    )
    rest = stage(
        summed.filter((~F.col("fits")) & (F.col("wanted") > 0) & (F.col("size") > 0)).select("at", "part", "n", "size"),
        "rest",
    )
    gaps = summed.groupBy("at").agg(F.max("wanted").alias("wanted")).join(reached, "at")
    gaps = gaps.select("at", (F.col("wanted") - F.col("reached")).alias("gap"), F.col("n_fit").alias("upto"))
    filled = _filled(rest, stage(gaps, "gaps")).withColumn("filled", F.lit(1))
    extra = F.when(F.col("fits"), 1).otherwise(F.coalesce("filled", F.lit(0)))
    return summed.join(filled, ["at", "n"], "left").withColumn("extra", extra)


def _running(placed: DataFrame, order: list[str]) -> DataFrame:
    """Add the running sum ``words`` and number ``n`` of a source's rows, in ``order`` inside ``part``, parts in turn."""
    # Words before each partition: a running sum over one row per partition and source.
    parts = placed.groupBy("at", "part").agg(F.sum("size").alias("part_words"), F.count(F.lit(1)).alias("part_n"))
    earlier = Window.partitionBy("at").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        F.col("at"),
        F.col("part"),
        F.coalesce(F.sum("part_words").over(earlier), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("part_n").over(earlier), F.lit(0)).alias("n_before"),
    )
    inside = Window.partitionBy("at", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(before, ["at", "part"]).withColumns(
        {
            "words": F.col("words_before") + F.sum("size").over(inside),
            "n": F.col("n_before") + F.count(F.lit(1)).over(inside),
        }
    )


def _filled(rest: DataFrame, gaps: DataFrame) -> DataFrame:
    """``(at, n)`` of the documents of ``rest`` that fill the gaps of their sources, in rank order."""
    none = rest.select("at", "n", "size").limit(0)
    taken, all_gaps = none, gaps.select("at", "gap")
    while True:
        fitting = rest.join(gaps, "at").filter("n > upto and size <= gap")
        fitting = stage(fitting.select("at", "part", F.col("n").alias("place"), "size", "gap"), "fitting")
        if fitting.isEmpty():
            break
        summed = stage(_running(fitting, ["place"]), "fitting_summed")
        fits = F.col("words") <= F.col("gap")
        reached = summed.groupBy("at").agg(
            F.max(F.when(fits, F.col("words"))).alias("reached"), F.max(F.when(fits, F.col("n"))).alias("n_fit")
        )
        marked = summed.join(reached, "at")
        near = marked.filter((F.col("n") > F.col("n_fit")) & (F.col("n") <= F.col("n_fit") + FILL_ROWS))
        more = _in_turn(near.select("at", "place", "size", (F.col("gap") - F.col("reached")).alias("gap")))
        some = stage(
            summed.filter(fits).select("at", F.col("place").alias("n"), "size").unionByName(more), "taken"
        )
        taken = taken.unionByName(some)
        looked = marked.filter(F.col("n") <= F.col("n_fit") + FILL_ROWS).groupBy("at")
        upto = looked.agg(F.max("gap").alias("old"), F.max("place").alias("upto"))
        sums = some.groupBy("at").agg(F.sum("size").alias("sum"))
        gaps = stage(upto.join(sums, "at").select("at", (F.col("old") - F.col("sum")).alias("gap"), "upto"), "gaps")
    # One more, if the words are nearer with it than without.
    sums = taken.groupBy("at").agg(F.sum("size").alias("sum"))
    left = rest.join(taken.select("at", "n"), ["at", "n"], "left_anti").groupBy("at")
    least = left.agg(F.min(F.struct("size", "n")).alias("least"))
    nearer = least.join(all_gaps, "at").join(sums, "at", "left").filter(
        F.col("least.size") < 2 * (F.col("gap") - F.coalesce("sum", F.lit(0)))
    )
    return taken.select("at", "n").unionByName(nearer.select("at", "least.n"))


def _in_turn(near: DataFrame) -> DataFrame:
    """Of at most FILL_ROWS documents of a source, in rank order, those that fit into its gap."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["at"]):
            gap, places, sizes = run.column("gap")[0].as_py(), [], []
            for place, size in zip(run.column("place").to_pylist(), run.column("size").to_pylist()):
                if size <= gap:
                    places.append(place)
                    sizes.append(size)
                    gap -= size
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([run.column("at")[0].as_py()] * len(places), pa.string()),
                    pa.array(places, pa.int64()),
                    pa.array(sizes, pa.int64()),
                ],
                names=["at", "n", "size"],
            )

    dealt = near.repartition("at").sortWithinPartitions("at", "place")
    return dealt.mapInArrow(fill, "at string, n bigint, size bigint")
