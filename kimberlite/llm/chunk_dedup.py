"""Removing stretches of lines that an earlier document, or the same one earlier, already has.

Boundaries are content-defined: a chunk begins where a rolling hash over the
next lines says so, and goes on to the first such line at least ``least_lines``
further. Text inserted anywhere moves only the boundaries around it. Digests of
the chunks are brought together over the whole table. Chunks that are found in a
row in the same place join to stretches; a stretch is compared with the earlier
one by its bytes, and goes on, line by line in both directions, as far as the
lines around it are alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kimberlite.llm.repeats import Parts, cut, later_ones, ranked
from kimberlite.llm.staged import broadcast_if_few, result
from kimberlite.llm.words import EXACT, Words, blocks, grams, mix, placed, stretches, words_of
from kimberlite.sources.scratch import stage

#: Bytes of lines; LF, CR and CRLF end them.
_IN_LINE = np.ones(256, bool)
_IN_LINE[[0x0A, 0x0D]] = False
_DRAW, _GAP = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


def lines_of(texts: list[bytes]) -> Words:
    return words_of(texts, _IN_LINE, exact=True)


def each_line(texts: list[bytes]) -> Parts:
    """The lines of texts, as the parts that are cut."""
    lines = lines_of(texts)
    if not len(lines.start):
        return Parts.none()
    begin, end = lines.start - lines.base[lines.doc], lines.end - lines.base[lines.doc]
    return Parts(lines.doc, begin, end, lines.hash, lines.hash, np.ones(len(begin), bool))


def chunks(lines: Words, least_lines: int, mean_lines: int, window: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """First lines of chunks and the lines behind their last ones, numbered over all texts.

    A chunk begins at the first line of a text, and at each line from which the
    rolling hash of ``window`` lines is 0 modulo ``mean_lines``; it ends before
    the first such line that is ``least_lines`` further, or with the text. Where
    fewer lines are left, none begins; a text of fewer is one chunk.
    """
    count = len(lines.start)
    begins, beyond_doc = lines.first[lines.doc], lines.first[lines.doc + 1]
    numbers = np.arange(count)
    drawn = np.zeros(count, bool)
    if mean_lines == 1:
        drawn[:] = True
    else:
        rolling = mix(grams(lines.hash, window) ^ _DRAW)
        drawn[: len(rolling)] = rolling % np.uint64(mean_lines) == 0
        drawn &= numbers + window <= beyond_doc  # the window lies in the text
    drawn |= numbers == begins
    first = np.flatnonzero(drawn & ((numbers + least_lines <= beyond_doc) | (numbers == begins)))
    # The next boundary from least_lines on, of this text or, beyond it, of a later one.
    following = np.r_[np.flatnonzero(drawn), count]
    beyond = following[np.searchsorted(following, np.minimum(first + least_lines, count))]
    return first, np.minimum(beyond, beyond_doc[first])


def digests(lines: Words, first: np.ndarray, beyond: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of stretches of lines; the second counts the line ends between them."""
    line = placed(lines.data, lines.start, lines.end, EXACT)
    ends = np.cumsum((lines.data == 0x0A) | ((lines.data == 0x0D) & (np.r_[lines.data[1:], 0] != 0x0A)))
    gap = np.r_[0, np.diff(ends[lines.start])].astype(np.uint64)
    behind = placed(line ^ mix(gap + _GAP), first + 1, beyond)
    return stretches(lines.hash, first, beyond), mix(behind ^ mix(line[first]))


def drop_repeated_chunks(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_lines: int = 2,
    mean_lines: int = 2,
) -> DataFrame:
    """``(id, text, n_parts, removed)`` for every row of ``docs``.

    ``text`` is what is left, ``n_parts`` the number of lines; ``removed`` lists
    the stretches taken out, with their UTF-8 byte range in the original and the
    id of the document that has them earlier. If lines of those were removed
    there in turn, that document's ``removed`` names the one before.

    A run of lines that stands earlier is found if a whole chunk lies in it:
    chunks begin at one line of ``mean_lines`` on average and have ``least_lines``
    or more. Then the lines around it go as well that are alike in the same
    earlier text, up to the chunk before and through the next one. With ``mean_lines`` 1 a chunk begins at each line, and every run
    of ``least_lines`` is found. Of texts with fewer lines, whole copies are
    found. Lines that repeat alone, and passages that begin or end within a line,
    stay. LF, CR and CRLF are alike; empty lines don't count as lines, but a run
    with others between is another run.

    Null texts stay null; empty ones have no lines. Of documents with equal
    runs, the smallest id keeps them, a null id last; rows equal in id and text
    are one document and get the same result, rows that share an id only are
    ranked by the hash of their text. Texts of any length are worked on whole.
    Other columns are not read. An empty table gives an empty result.
    """
    if least_lines < 1 or mean_lines < 1:
        raise ValueError("least_lines and mean_lines must be at least 1")

    def make() -> DataFrame:
        texts = ranked(docs, id_column, text_column)
        found = stage(_occurrences(texts, least_lines, mean_lines), "chunks")
        joined = stage(_stretches(later_ones(found)), "stretches")
        gone = _same_bytes(texts, joined, least_lines, mean_lines)
        return cut(texts, gone, each_line).withColumnRenamed("id", id_column)

    return result(docs.sparkSession, make)


def _occurrences(texts: DataFrame, least_lines: int, mean_lines: int) -> DataFrame:
    """Digest, first line and number of lines of every chunk."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begun, some in blocks(batch.column("text")):
                lines = lines_of(some)
                if not len(lines.start):
                    continue
                first, beyond = chunks(lines, least_lines, mean_lines)
                key_1, key_2 = digests(lines, first, beyond)
                at = pa.array(lines.doc[first])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key_1.view(np.int64)),
                        pa.array(key_2.view(np.int64)),
                        batch.column("rank").slice(begun, len(some)).take(at),
                        batch.column("hash").slice(begun, len(some)).take(at),
                        pa.array((first - lines.first[lines.doc[first]]).astype(np.int32)),
                        pa.array((beyond - first).astype(np.int32)),
                    ],
                    names=["key_1", "key_2", "rank", "hash", "part", "n"],
                )

    kinds = "key_1 bigint, key_2 bigint, rank bigint, hash bigint, part int, n int"
    return texts.select("rank", "hash", "text").mapInArrow(rows, kinds)


def _stretches(later: DataFrame) -> DataFrame:
    """Chunks that touch, as their first ones do: ``(rank, hash, part, n, f_rank, f_hash, f_part)``, in lines."""
    place = F.struct("part", "n", F.col("first.rank"), F.col("first.hash"), F.col("first.part").alias("at"))
    found = later.groupBy("rank", "hash").agg(F.collect_list(place).alias("found"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rank, hash, found in zip(batch.column("rank"), batch.column("hash"), batch.column("found")):
                part, n, f_rank, f_hash, f_part = (x.to_numpy() for x in found.values.flatten())
                order = np.lexsort((part, f_part - part, f_hash, f_rank))
                part, n, f_rank, f_hash, f_part = (x[order] for x in (part, n, f_rank, f_hash, f_part))
                other = np.ones(len(part), bool)
                other[1:] = (np.diff(f_part - part) != 0) | (f_rank[1:] != f_rank[:-1]) | (f_hash[1:] != f_hash[:-1])
                # Where the stretches of one place so far end: each place counts on from the one before.
                shift = np.cumsum(other) * (int((part + n).max()) + 1)
                reached = np.maximum.accumulate(part + n + shift)
                new = other.copy()
                new[1:] |= (part + shift)[1:] > reached[:-1]
                first = np.flatnonzero(new)
                last = np.r_[first[1:], len(part)] - 1
                some = len(first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([rank.as_py()] * some, pa.int64()),
                        pa.array([hash.as_py()] * some, pa.int64()),
                        pa.array(part[first].astype(np.int32)),
                        pa.array(((reached - shift)[last] - part[first]).astype(np.int32)),
                        pa.array(f_rank[first]),
                        pa.array(f_hash[first]),
                        pa.array(f_part[first].astype(np.int32)),
                    ],
                    names=["rank", "hash", "part", "n", "f_rank", "f_hash", "f_part"],
                )

    return found.mapInArrow(rows, "rank bigint, hash bigint, part int, n int, f_rank bigint, f_hash bigint, f_part int")


def _same_bytes(texts: DataFrame, joined: DataFrame, least_lines: int, mean_lines: int) -> DataFrame:
    """The lines of stretches whose bytes are those of the earlier ones, with the lines alike around them."""
    firsts = joined.select(F.col("f_rank").alias("rank"), F.col("f_hash").alias("hash"), F.col("f_part").alias("part"), "n")
    places = joined.select("rank", "hash", "part", "n").unionByName(firsts).distinct()
    wanted = places.groupBy("rank", "hash").agg(F.collect_list(F.struct("part", "n")).alias("parts"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bytes of each place, and the lines around it that its own next chunks reach."""
        for batch in batches:
            for begun, some in blocks(batch.column("text")):
                lines = lines_of(some)
                first, beyond = chunks(lines, least_lines, mean_lines)
                asked = batch.column("parts").slice(begun, len(some)).to_pylist()
                doc = np.repeat(np.arange(len(some)), [len(a) for a in asked])
                part = np.array([p["part"] for a in asked for p in a], np.int64) + lines.first[doc]
                n = np.array([p["n"] for a in asked for p in a], np.int64)
                low, high = lines.first[doc], lines.first[doc + 1]
                before = np.maximum(first[np.maximum(np.searchsorted(first, part) - 1, 0)], low)
                # The end of the next chunk, or of the text.
                after = np.r_[beyond, len(lines.start)][np.searchsorted(first, part + n, "right")] + 1
                after = np.minimum(after, high)

                def bytes_of(a: int, b: int) -> bytes:
                    return _settled(lines.data[lines.start[a] : lines.end[b - 1]].tobytes()) if a < b else b""

                def each(a: int, b: int) -> list[bytes]:
                    """Lines with the line ends before them, which must be alike as well."""
                    return [_settled(lines.data[lines.end[k - 1] : lines.end[k]].tobytes()) for k in range(a, b)]

                def each_back(a: int, b: int) -> list[bytes]:
                    return [_settled(lines.data[lines.start[k] : lines.start[k + 1]].tobytes()) for k in range(b - 1, a - 1, -1)]

                ranges = list(zip(before.tolist(), part.tolist(), (part + n).tolist(), after.tolist()))
                list_of = pa.list_(pa.large_binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rank").slice(begun, len(some)).take(pa.array(doc)),
                        batch.column("hash").slice(begun, len(some)).take(pa.array(doc)),
                        pa.array((part - low).astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                        pa.array([bytes_of(b, c) for _, b, c, _ in ranges], pa.large_binary()).cast(pa.binary()),
                        pa.array([each_back(a, b) for a, b, _, _ in ranges], list_of).cast(pa.list_(pa.binary())),
                        pa.array([each(c, d) for _, _, c, d in ranges], list_of).cast(pa.list_(pa.binary())),
                    ],
                    names=["rank", "hash", "part", "n", "held", "before", "after"],
                )

    keys = broadcast_if_few(stage(wanted.select("rank", "hash"), "wanted"))
    asked = texts.select("rank", "hash", "text").join(keys, ["rank", "hash"], "left_semi")
    asked = asked.join(wanted, ["rank", "hash"]).dropDuplicates(["rank", "hash"])
    out = "rank bigint, hash bigint, part int, n int, held binary, before array<binary>, after array<binary>"
    held = stage(asked.mapInArrow(rows, out), "held")
    place, found = ["rank", "hash", "part"], ["held", "before", "after"]
    earlier = held.select(*[F.col(c).alias(f"f_{c}") for c in place + found], "n")
    compared = joined.join(held, [*place, "n"]).join(earlier, ["f_rank", "f_hash", "f_part", "n"]).filter("held = f_held")

    def alike(one: str, two: str):
        """How many lines are the same from the stretch outwards."""
        same = F.zip_with(F.col(one), F.col(two), lambda a, b: F.coalesce(a == b, F.lit(False)))
        first = F.array_position(same, False)
        return F.when(first == 0, F.size(same)).otherwise(first - 1).cast("int")

    own = (F.col("rank") == F.col("f_rank")) & (F.col("hash") == F.col("f_hash"))
    # What overlaps its own repeat ("a a a") leaves the lines of the first.
    begin = F.when(own, F.greatest("part", F.col("f_part") + F.col("n")))
    begin = begin.otherwise(F.col("part") - alike("before", "f_before"))
    last = F.col("part") + F.col("n") - 1 + F.when(own, 0).otherwise(alike("after", "f_after"))
    return compared.select(
        "rank", "hash", begin.alias("part"), last.alias("last"), F.struct(F.col("f_rank").alias("rank")).alias("first")
    ).filter("part <= last")


def _settled(text: bytes) -> bytes:
    return text.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
