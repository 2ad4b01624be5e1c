"""Parts of texts that repeat across a table: which to keep, and cutting the rest.

A part is known by a 128-bit digest, and by its document and number in it. The
occurrence in the document with the smallest id is kept (then the smallest hash
of the text, then the first in the text); a null id ranks last. Rows that are
equal in id and text count as one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kimberlite.llm.words import blocks

_KEY = ["key_1", "key_2"]
_PLACE = ["rank", "hash", "part"]
_LAST = (1 << 63) - 1


class Parts:
    """Parts of a block of texts: text number, byte range in it, two independent 64-bit hashes, whether they count."""

    def __init__(
        self,
        doc: np.ndarray,
        begin: np.ndarray,
        end: np.ndarray,
        hash_1: np.ndarray,
        hash_2: np.ndarray,
        counts: np.ndarray,
    ):
        self.doc, self.begin, self.end, self.counts = doc, begin, end, counts
        self.hash_1, self.hash_2 = hash_1, hash_2

    @classmethod
    def none(cls) -> Parts:
        places, hashes = np.empty(0, np.int64), np.empty(0, np.uint64)
        return cls(places, places, places, hashes, hashes, np.empty(0, bool))

    def numbers(self) -> np.ndarray:
        """Each part's number in its text."""
        first = np.searchsorted(self.doc, self.doc, side="left")
        return np.arange(len(self.doc)) - first


Splitter = Callable[[list[bytes]], Parts]


def ranked(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(_LAST)).alias("rank"),
        F.xxhash64(text_column).alias("hash"),
        F.col(id_column).cast("bigint").alias("id"),
        F.col(text_column).alias("text"),
    )


def occurrences(texts: DataFrame, split: Splitter) -> DataFrame:
    """Digest and place of every part that counts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begun, some in blocks(batch.column("text")):
                parts = split(some)
                use = np.flatnonzero(parts.counts)
                at = pa.array(parts.doc[use])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(parts.hash_1[use].view(np.int64)),
                        pa.array(parts.hash_2[use].view(np.int64)),
                        batch.column("rank").slice(begun, len(some)).take(at),
                        batch.column("hash").slice(begun, len(some)).take(at),
                        pa.array(parts.numbers()[use].astype(np.int32)),
                    ],
                    names=[*_KEY, *_PLACE],
                )

    kinds = "key_1 bigint, key_2 bigint, rank bigint, hash bigint, part int"
    return texts.select("rank", "hash", "text").mapInArrow(rows, kinds)


def later_ones(found: DataFrame) -> DataFrame:
    """Of staged ``occurrences``, all but the first of each digest, with the first's place."""
    place = F.struct(*_PLACE)
    first = found.groupBy(*_KEY).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = first.filter("first <> last").select(*_KEY, "first")
    return found.join(repeated, _KEY).filter(place != F.col("first"))


def cut(texts: DataFrame, later: DataFrame, split: Splitter) -> DataFrame:
    """``(id, text, n_parts, removed)``: the texts without their ``later`` parts.

    ``removed`` has each removed part's UTF-8 byte range in the original text and
    the id of the document that keeps it. Blanks after a removed part go too.
    With a column ``last``, a row of ``later`` stands for the parts up to that;
    of rows that overlap, each loses what is in one before it.
    """
    last = F.col("last") if "last" in later.columns else F.col("part").alias("last")
    gone = (
        later.groupBy("rank", "hash")
        .agg(F.collect_list(F.struct("part", last, F.col("first.rank").alias("kept_in"))).alias("gone"))
        .withColumnsRenamed({"rank": "g_rank", "hash": "g_hash"})
    )
    joined = texts.join(gone, (F.col("rank") == F.col("g_rank")) & (F.col("hash") == F.col("g_hash")), "left")
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("kept_in", pa.int64())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begun, some in blocks(batch.column("text")):
                parts = split(some)
                counts = np.bincount(parts.doc, minlength=len(some))
                first = np.cumsum(counts) - counts
                there = batch.column("text").slice(begun, len(some)).is_valid()
                left, removed = [], []
                for i, gone in enumerate(batch.column("gone").slice(begun, len(some))):
                    spans, beyond = [], 0
                    for g in sorted(gone.as_py() or [], key=lambda g: (g["part"], -g["last"])):
                        begin = max(g["part"], beyond)
                        beyond = max(beyond, g["last"] + 1)
                        if begin > g["last"]:
                            continue
                        at, end = first[i] + begin, first[i] + g["last"]
                        kept_in = None if g["kept_in"] == _LAST else g["kept_in"]
                        spans.append({"begin": int(parts.begin[at]), "end": int(parts.end[end]), "kept_in": kept_in})
                    left.append(_without(some[i], spans))
                    removed.append(spans)
                texts = pa.array([t.decode("utf-8", "replace") for t in left], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(begun, len(some)),
                        pc.if_else(there, texts, pa.scalar(None, pa.string())),
                        pa.array(counts, pa.int64()),
                        pa.array(removed, kind),
                    ],
                    names=["id", "text", "n_parts", "removed"],
                )

    out = "id bigint, text string, n_parts bigint, removed array<struct<begin:bigint,end:bigint,kept_in:bigint>>"
    return joined.select("id", "text", "gone").mapInArrow(rows, out)


def _without(text: bytes, spans: list[dict]) -> bytes:
    if not spans:
        return text
    pieces, at = [], 0
    for span in spans:
        pieces.append(text[at : span["begin"]])
        at = span["end"]
        while at < len(text) and text[at] in b" \t\n\r\f\v":
            at += 1
    return b"".join([*pieces, text[at:]])
