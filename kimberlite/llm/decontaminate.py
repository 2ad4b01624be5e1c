"""Benchmark decontamination by winnowing.

A text's fingerprints are the smallest of every ``span_words - gram_words + 1``
consecutive hashes of ``gram_words`` words. Two texts that share a run of
``span_words`` words share the choice in it, so joining the fingerprints of
documents with those of benchmark items finds every such run. A hit is extended
to the runs of the item that contain its fingerprint, which are then looked up
in the document. Items shorter than ``span_words`` count as one run of their own
length, found the same way with fingerprints for that length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kimberlite.llm.row_keys import told_apart
from kimberlite.llm.staged import if_few, result
from kimberlite.llm.words import ALPHANUMERIC, Words, blocks, grams, mix, starts_inside, words_of
from kimberlite.sources.scratch import stage

_SPAN = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("begin", pa.int64()), ("end", pa.int64())])
_OUT = pa.schema(
    [
        ("id", pa.int64()),
        ("text_hash", pa.int64()),
        ("n_words", pa.int64()),
        ("spans", pa.list_(_SPAN)),
        ("items", pa.list_(pa.string())),
    ]
)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    span_words: int = 10,
    gram_words: int = 5,
) -> DataFrame:
    """``(id, text_hash, n_words, spans, items)`` for every row of ``docs``.

    Words are ASCII letters, digits and non-ASCII characters, A-Z lowered. A
    span is a stretch of words, numbers ``first`` to ``last``, each inside a run
    of ``span_words`` words that some item has too, with the UTF-8 byte range
    ``begin`` to ``end``; spans don't overlap. ``items`` lists, as sorted
    strings, the items with such runs.

    Null or empty texts have no words and no spans; items without words are
    ignored. An item without id marks words but is not listed; rows that repeat
    an item id count as one item. Documents without an id, or that repeat one,
    are judged by their own text. Other columns are not read. Empty tables, on
    either side, are valid.
    """

    def make() -> DataFrame:
        texts = told_apart(docs, id_column, text_column)
        items = benchmark.select(
            F.col(item_column).cast("string").alias("item"), F.col(item_text_column).alias("text")
        )
        known = stage(_item_prints(items, span_words, gram_words), "prints")
        # At most one number for each length up to span_words.
        widths = sorted(r["width"] for r in known.select("width").distinct().collect())
        hits = (
            _prints(texts, widths, gram_words)
            .join(known, "key")
            .groupBy("id")
            .agg(F.collect_set(F.struct("item", "width", "runs")).alias("hits"))
        )
        hits = stage(hits.withColumnRenamed("id", "hit_id"), "hits")
        same = F.col("id").eqNullSafe(F.col("hit_id"))
        columns = ["id", "text_hash", "text", "hits"]
        few = if_few(stage(hits.select("hit_id"), "hit-ids"))
        if few is None:
            return _marked(texts.join(hits, same, "left").select(*columns)).withColumnRenamed("id", id_column)
        # Only documents with hits are shuffled with their text.
        clean = texts.join(few, same, "left_anti").withColumn("hits", F.lit(None).cast(hits.schema["hits"].dataType))
        hit = texts.join(few, same, "left_semi").join(hits, same)
        return _marked(clean.unionByName(hit.select(*columns))).withColumnRenamed("id", id_column)

    return result(docs.sparkSession, make)


def _winnow(words: Words, width: int, gram_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and keys of the fingerprints that find runs of ``width`` words."""
    n = min(gram_words, width)
    window = width - n + 1
    hashes = grams(words.hash, n)
    begin = np.flatnonzero(starts_inside(words, width))
    if not len(begin):
        return begin, np.empty(0, np.uint64)
    best, at = hashes[begin], begin.copy()
    for j in range(1, window):
        other = hashes[begin + j]
        smaller = other <= best
        best[smaller] = other[smaller]
        at[smaller] = begin[smaller] + j
    at = np.unique(at)
    return at, mix(hashes[at] ^ np.uint64(width))


def _prints(texts: DataFrame, widths: list[int], gram_words: int) -> DataFrame:
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begun, some in blocks(batch.column("text")):
                words = words_of(some, ALPHANUMERIC)
                ids = batch.column("id").slice(begun, len(some))
                for width in widths:
                    at, keys = _winnow(words, width, gram_words)
                    doc = words.doc[at]
                    order = np.lexsort((keys, doc))
                    doc, keys = doc[order], keys[order]
                    new = np.ones(len(keys), bool)
                    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(doc[new])), pa.array(keys[new].view(np.int64))], names=["id", "key"]
                    )

    return texts.mapInArrow(prints, "id bigint, key bigint")


def _item_prints(items: DataFrame, span_words: int, gram_words: int) -> DataFrame:
    """Each fingerprint of an item with the hashes of the item's runs around it."""
    schema = pa.schema(
        [("key", pa.int64()), ("item", pa.string()), ("width", pa.int32()), ("runs", pa.list_(pa.int64()))]
    )

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("item").to_pylist()
            for begun, some in blocks(batch.column("text")):
                rows = []
                for i, text in enumerate(some):
                    words = words_of([text], ALPHANUMERIC)
                    width = min(span_words, len(words.hash))
                    if not width:
                        continue
                    runs = grams(words.hash, width).view(np.int64)
                    reach = width - min(gram_words, width)
                    for at, key in zip(*_winnow(words, width, gram_words)):
                        around = runs[max(0, at - reach) : at + 1].tolist()
                        rows.append((key.astype(np.int64), names[begun + i], width, around))
                columns = zip(*rows) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
                )

    return items.mapInArrow(prints, "key bigint, item string, width int, runs array<bigint>").distinct()


def _marked(joined: DataFrame) -> DataFrame:
    """The runs near each document's hits, looked up in the document."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begun, some in blocks(batch.column("text")):
                words = words_of(some, ALPHANUMERIC)
                counts = np.diff(words.first)
                hits = batch.column("hits").slice(begun, len(some)).to_pylist()
                spans, items = [], []
                for i, found in enumerate(hits):
                    marked = _mark(words, i, found) if found else ([], [])
                    spans.append(marked[0])
                    items.append(marked[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(begun, len(some)),
                        batch.column("text_hash").slice(begun, len(some)),
                        pa.array(counts, pa.int64()),
                        pa.array(spans, _OUT.field("spans").type),
                        pa.array(items, _OUT.field("items").type),
                    ],
                    schema=_OUT,
                )

    return joined.mapInArrow(
        mark,
        "id bigint, text_hash bigint, n_words bigint, spans array<struct<first:int,last:int,begin:bigint,end:bigint>>, "
        "items array<string>",
    )


def _mark(words: Words, doc: int, hits: list[dict]) -> tuple[list[dict], list[str]]:
    first, beyond = words.first[doc], words.first[doc + 1]
    hashes, items = words.hash[first:beyond], set()
    edges = np.zeros(len(hashes) + 1, np.int64)
    for width in {h["width"] for h in hits}:
        own = grams(hashes, width).view(np.int64)
        near = [h for h in hits if h["width"] == width]
        begin = np.flatnonzero(np.isin(own, np.concatenate([np.array(h["runs"], np.int64) for h in near])))
        np.add.at(edges, begin, 1)
        np.add.at(edges, begin + width, -1)
        present = set(own[begin].tolist())
        items.update(h["item"] for h in near if h["item"] is not None and not present.isdisjoint(h["runs"]))
    inside = np.concatenate([[False], np.cumsum(edges[:-1]) > 0, [False]])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    spans = [
        {
            "first": int(a),
            "last": int(b) - 1,
            "begin": int(words.start[first + a] - words.base[doc]),
            "end": int(words.end[first + b - 1] - words.base[doc]),
        }
        for a, b in zip(change[0::2], change[1::2])
    ]
    return spans, sorted(items)
