"""Bigram model with interpolated modified Kneser-Ney smoothing.

Counts are made in Spark from all training texts. Words are 64-bit hashes in the
vocabulary and their upper 48 bits in bigrams. A task gathers some millions of
tokens, sorts them and sends each shard one packed block of its distinct
bigrams, so little more than the bigrams themselves is shuffled. Shards are
ranges of the first word; the few words that are first in very many bigrams are
dealt over shards of their own by the second word. Each shard becomes a file of
arrays sorted by hash: bigrams with counts, first words with the sums their
smoothing needs, words with the number of different words before them. Workers
map the files and look up what their texts need; no model is held in memory or
sent anywhere.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kimberlite.llm.rows import runs
from kimberlite.llm.shared_files import read_from, write_to
from kimberlite.llm.words import BLANK_SEPARATED, blocks, mix, words_of
from kimberlite.sources.scratch import scratch_root, stage, staging

#: Tokens that a task gathers before it sends them on.
GATHERED = 4_000_000
#: Tokens for each shard.
SHARD_TOKENS = 2_000_000
#: A first word with more tokens than this gets shards of its own ...
HOT_TOKENS = 1_000_000
#: ... but no more words than this do.
MOST_HOT = 50_000
_MOST_SHARDS = 60_000
_ID_BITS = np.uint64(16)
_BASE = np.uint64(0x9E3779B97F4A7C15)
END = mix(np.array([0xE0D], np.uint64))[0]
_START = mix(np.array([0x57A7], np.uint64))[0] >> _ID_BITS
_opened: dict[str, list[np.ndarray]] = {}


@dataclass
class Layout:
    """Which shard holds what."""

    shards: int
    hot: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))  # sorted ids
    hot_shards: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def of(self, ids: np.ndarray) -> np.ndarray:
        return ((ids * np.uint64(self.shards)) >> np.uint64(48)).astype(np.int64)

    def of_pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        shard = self.of(first)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, first), len(self.hot) - 1)
            mine = np.flatnonzero(self.hot[at] == first)
            at = at[mine]
            begin = self.shards + np.cumsum(self.hot_shards) - self.hot_shards
            shard[mine] = begin[at] + (mix(second[mine]) % self.hot_shards[at].astype(np.uint64)).astype(np.int64)
        return shard


@dataclass
class Model:
    """Files by shard and the figures that hold for all of them."""

    layout: Layout
    tokens: int = 0
    kinds: int = 0
    vocabulary: dict[int, tuple[str, int]] = field(default_factory=dict)
    pairs: dict[int, tuple[str, int]] = field(default_factory=dict)
    firsts: dict[int, tuple[str, int]] = field(default_factory=dict)
    seconds: dict[int, tuple[str, int]] = field(default_factory=dict)
    hot_sums: np.ndarray = field(default_factory=lambda: np.zeros((0, 4)))
    pair_discounts: np.ndarray = field(default_factory=lambda: np.zeros(4))
    word_discounts: np.ndarray = field(default_factory=lambda: np.zeros(4))
    pair_kinds: int = 0
    word_rest: float = 0.0


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length, the first ascending, as compressed byte planes."""
    first = columns[0].copy()
    first[1:] -= columns[0][:-1]
    out = [np.int64(len(first)).tobytes()]
    for column in (first, *columns[1:]):
        planes = np.ascontiguousarray(column.view(np.uint8).reshape(len(column), -1).T).tobytes()
        packed = pa.compress(planes, codec="zstd", asbytes=True)
        out += [np.int64(len(packed)).tobytes(), packed]
    return b"".join(out)


def _unpack(data: bytes, *kinds: type) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(data, np.int64, 1)[0]), 8, []
    for kind in kinds:
        size = int(np.frombuffer(data, np.int64, 1, at)[0])
        wide = np.dtype(kind).itemsize
        planes = pa.decompress(data[at + 8 : at + 8 + size], n * wide, codec="zstd", asbytes=True)
        out.append(np.frombuffer(planes, np.uint8).reshape(wide, n).T.copy(order="C").view(kind).ravel())
        at += 8 + size
    np.cumsum(out[0], out=out[0])
    return out


def _save(path: str, *columns: np.ndarray) -> str:
    with write_to(path) as file:
        for column in columns:
            file.write(np.ascontiguousarray(column))
    return path


def _load(place: tuple[str, int], *kinds: type) -> list[np.ndarray]:
    """Views of a mapped file's columns; a worker process maps each file once."""
    path, n = place
    if path not in _opened:
        data, at, columns = read_from(path).read_buffer(), 0, []
        for kind in kinds:
            columns.append(np.frombuffer(data, kind, n, at))
            at += n * np.dtype(kind).itemsize
        _opened[path] = columns
    return _opened[path]


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the texts' words, each text's followed by END, and where each text begins and ends."""
    words = words_of(texts, BLANK_SEPARATED)
    n = np.diff(words.first) + 1
    ends = np.cumsum(n)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    out[np.arange(len(words.hash)) + words.doc] = words.hash
    out[ends - 1] = END
    return out, ends - n, ends


def _pairs(tokens: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    second = tokens >> _ID_BITS
    first = np.empty_like(second)
    first[1:] = second[:-1]
    first[begin] = _START
    return first, second


def fit(texts: DataFrame, text_column: str = "text") -> Model:
    """Count a model from all rows of ``texts``; a null text is an empty one.

    Its files lie beside the staged tables. Tables without rows give a model that
    finds every token equally likely.
    """
    spark = texts.sparkSession
    folder = f"{scratch_root(spark)}/kimberlite/model-{uuid.uuid4().hex}"
    plain = texts.select(F.col(text_column).alias("text"))
    with staging(spark):
        # About six bytes of text for a token; one number, and shards only set how work is cut.
        n_bytes = plain.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
        guess = (n_bytes[0] or 0) // 6 + n_bytes[1]
        shards = int(min(max(1, guess // SHARD_TOKENS), _MOST_SHARDS))
        model = Model(Layout(shards))
        if not n_bytes[1]:
            return model
        _count_words(plain, model, folder)
        _find_hot(spark, model, n_bytes[1])
        _count_pairs(plain, model, folder)
    return model


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens of many texts and the places where a text begins."""
    held, begins, n = [], [], 0
    for batch in batches:
        for _, some in blocks(batch.column("text")):
            tokens, begin, _ = _tokens(some)
            held.append(tokens)
            begins.append(begin + n)
            n += len(tokens)
            if n >= GATHERED:
                yield np.concatenate(held), np.concatenate(begins)
                held, begins, n = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(begins)


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    kinds, first = np.unique(shard[order], return_index=True)
    for k, places in zip(kinds.tolist(), np.split(order, first[1:])):
        yield k, places


def _count_words(texts: DataFrame, model: Model, folder: str) -> None:
    layout = model.layout

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, _ in _gathered(batches):
            kinds, count = np.unique(tokens, return_counts=True)
            shard = layout.of(kinds >> _ID_BITS)
            rows = [(k, _pack(kinds[at], count[at].astype(np.uint32))) for k, at in _by_shard(shard)]
            yield _batch(["shard", "block"], [pa.int32(), pa.binary()], rows)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["shard"]):
            parts = [_unpack(b.as_py(), np.uint64, np.uint32) for b in run.column("block")]
            words, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            count = np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.uint64)
            path = _save(f"{folder}/words-{uuid.uuid4().hex}", words, count)
            row = (run.column("shard")[0].as_py(), path, len(words), int(count.sum()))
            yield _batch(["shard", "path", "n", "tokens"], [pa.int32(), pa.string(), pa.int64(), pa.int64()], [row])

    sent = texts.mapInArrow(send, "shard int, block binary").repartition(layout.shards, "shard")
    made = sent.sortWithinPartitions("shard").mapInArrow(merge, "shard int, path string, n bigint, tokens bigint")
    for row in stage(made, "words").collect():  # a row per shard
        model.vocabulary[row["shard"]] = (row["path"], row["n"])
        model.tokens += row["tokens"]
        model.kinds += row["n"]


def _find_hot(spark, model: Model, n_texts: int) -> None:
    least = max(HOT_TOKENS, model.tokens // MOST_HOT)
    files = spark.createDataFrame([(p, n) for p, n in model.vocabulary.values()], "path string, n bigint")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, count = _load((row["path"], row["n"]), np.uint64, np.uint64)
                at = np.flatnonzero(count >= least)
                found = zip((words[at] >> _ID_BITS).astype(np.int64).tolist(), count[at].tolist())
                yield _batch(["id", "n"], [pa.int64(), pa.int64()], list(found))

    end = int(END >> _ID_BITS)
    rows = files.repartition(len(model.vocabulary)).mapInArrow(look, "id bigint, n bigint").collect()
    found = {r["id"]: r["n"] for r in rows if r["id"] != end}  # at most MOST_HOT; nothing follows END
    found[int(_START)] = n_texts
    ids = np.array(sorted(found), np.uint64)
    model.layout.hot = ids
    model.layout.hot_shards = np.array([-(-found[int(i)] // least) for i in ids], np.int64)


def _count_pairs(texts: DataFrame, model: Model, folder: str) -> None:
    layout = model.layout

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens, begin in _gathered(batches):
            first, second = _pairs(tokens, begin)
            order = np.argsort((first << _ID_BITS) | (second & np.uint64(0xFFFF)))
            first, second = first[order], second[order]
            new = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
            count = np.diff(np.r_[new, len(first)]).astype(np.uint32)
            first, second = first[new], second[new]
            for k, at in _by_shard(layout.of_pairs(first, second)):
                row = (k, 0, None, None, _pack(first[at], _narrow(second[at]), _upper(second[at]), count[at]))
                yield _batch(_ROW, _ROW_KINDS, [row])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["shard"]):
            shard = run.column("shard")[0].as_py()
            parts = [_unpack(b.as_py(), np.uint64, np.uint32, np.uint16, np.uint32) for b in run.column("block")]
            first = np.concatenate([p[0] for p in parts])
            second = np.concatenate([(p[2].astype(np.uint64) << np.uint64(32)) | p[1] for p in parts])
            keys, index, at = np.unique(_pair_key(first, second), return_index=True, return_inverse=True)
            count = np.bincount(at, weights=np.concatenate([p[3] for p in parts])).astype(np.uint64)
            first, second = first[index], second[index]
            stats = [len(keys), *(int((count == k).sum()) for k in (1, 2, 3, 4))]
            path = _save(f"{folder}/pairs-{uuid.uuid4().hex}", keys, np.minimum(count, 2**32 - 1).astype(np.uint32))
            yield _batch(_ROW, _ROW_KINDS, [(shard, 1, path, stats, None)])
            kinds, at = np.unique(first, return_inverse=True)
            sums = np.stack(
                [
                    np.bincount(at, weights=w).astype(np.uint64)
                    for w in (count, count == 1, count == 2, count >= 3)
                ]
            )
            if shard < layout.shards:
                path = _save(f"{folder}/firsts-{uuid.uuid4().hex}", kinds, *sums)
                yield _batch(_ROW, _ROW_KINDS, [(shard, 2, path, [len(kinds)], None)])
            else:
                rows = [(shard, 3, None, [int(k), *map(int, s)], None) for k, s in zip(kinds, sums.T)]
                yield _batch(_ROW, _ROW_KINDS, rows)
            kinds, count = np.unique(second, return_counts=True)
            for k, at in _by_shard(layout.of(kinds)):
                block = _pack(kinds[at], count[at].astype(np.uint32))
                yield _batch(_ROW, _ROW_KINDS, [(k, 4, None, None, block)])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["shard", "kind"]):
            shard, kind = run.column("shard")[0].as_py(), run.column("kind")[0].as_py()
            if kind != 4:
                yield from run.to_batches()
                continue
            parts = [_unpack(b.as_py(), np.uint64, np.uint32) for b in run.column("block")]
            words, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            count = np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.uint64)
            path = _save(f"{folder}/seconds-{uuid.uuid4().hex}", words, count)
            stats = [len(words), *(int((count == k).sum()) for k in (1, 2, 3, 4))]
            yield _batch(_ROW, _ROW_KINDS, [(shard, 5, path, stats, None)])

    every = layout.shards + int(layout.hot_shards.sum())
    kinds = "shard int, kind int, path string, stats array<bigint>, block binary"
    sent = texts.mapInArrow(send, kinds).repartition(every, "shard").sortWithinPartitions("shard")
    met = sent.mapInArrow(merge, kinds).repartition(layout.shards, "shard").sortWithinPartitions("shard", "kind")
    made = stage(met.mapInArrow(gather, kinds).drop("block"), "pairs")
    pair_counts, word_counts = np.zeros(5, np.int64), np.zeros(5, np.int64)
    model.hot_sums = np.zeros((len(layout.hot), 4))
    for row in made.collect():  # a few rows per shard
        place = (row["path"], row["stats"][0])
        if row["kind"] == 1:
            model.pairs[row["shard"]] = place
            pair_counts += row["stats"]
        elif row["kind"] == 2:
            model.firsts[row["shard"]] = place
        elif row["kind"] == 3:
            model.hot_sums[np.searchsorted(layout.hot, np.uint64(row["stats"][0]))] += row["stats"][1:]
        else:
            model.seconds[row["shard"]] = place
            word_counts += row["stats"]
    model.pair_kinds = int(pair_counts[0])
    model.pair_discounts, model.word_discounts = _discounts(pair_counts), _discounts(word_counts)
    ones, twos = word_counts[1], word_counts[2]
    by_count = np.array([ones, twos, word_counts[0] - ones - twos])
    model.word_rest = float(model.word_discounts[1:] @ by_count) / max(1, model.pair_kinds)


_ROW = ["shard", "kind", "path", "stats", "block"]
_ROW_KINDS = [pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.binary()]


def _batch(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _narrow(ids: np.ndarray) -> np.ndarray:
    return (ids & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _upper(ids: np.ndarray) -> np.ndarray:
    return (ids >> np.uint64(32)).astype(np.uint16)


def _pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first * _BASE) + second)


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more, after a zero for none.

    ``counts`` has the number of kinds that occur once, twice, ... after their total.
    Where a formula divides by nothing or leaves its range, half the count is taken.
    """
    n = counts.astype(float)
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    out = [0.0]
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k + 1] / n[k] if n[k] and y else k / 2
        out.append(d if 0 < d < k else k / 2)
    return np.array(out)


def _look_up(files: dict, shard: np.ndarray, keys: np.ndarray, kinds: tuple) -> list[np.ndarray]:
    """The columns after the first for each key, 0 where it isn't held."""
    out = [np.zeros(len(keys)) for _ in kinds[1:]]
    for k, places in _by_shard(shard):
        if k not in files:
            continue
        held, *columns = _load(files[k], *kinds)
        at = np.minimum(np.searchsorted(held, keys[places]), len(held) - 1)
        hit = held[at] == keys[places]
        for target, column in zip(out, columns):
            target[places[hit]] = column[at[hit]]
    return out


def log_probabilities(model: Model, tokens: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token its log10 probability and its count in training."""
    layout = model.layout
    kinds, word = np.unique(tokens, return_inverse=True)
    ids = kinds >> _ID_BITS
    shard = layout.of(ids)
    (count,) = _look_up(model.vocabulary, shard, kinds, (np.uint64, np.uint64))
    (before,) = _look_up(model.seconds, shard, ids, (np.uint64, np.uint64))
    alone = (before - model.word_discounts[np.minimum(before, 3).astype(int)]) / max(1, model.pair_kinds)
    # The rest, or all of it if nothing was learned, is shared by known words and one unknown.
    rest = model.word_rest if model.pair_kinds else 1.0
    alone = alone + rest / (model.kinds + 1)
    first, second = _pairs(tokens, begin)
    firsts, of_first = np.unique(first, return_inverse=True)
    sums = np.stack(_look_up(model.firsts, layout.of(firsts), firsts, (np.uint64,) * 5))
    if len(layout.hot):
        at = np.minimum(np.searchsorted(layout.hot, firsts), len(layout.hot) - 1)
        hot = layout.hot[at] == firsts
        sums[:, hot] = model.hot_sums[at[hot]].T
    total = sums[0]
    seen = total > 0
    share = np.where(seen, (model.pair_discounts[1:] @ sums[1:]) / np.maximum(total, 1), 1.0)
    keys = _pair_key(first, second)
    some, index, of_key = np.unique(keys, return_index=True, return_inverse=True)
    (met,) = _look_up(model.pairs, layout.of_pairs(first[index], second[index]), some, (np.uint64, np.uint32))
    met = met[of_key]
    direct = (met - model.pair_discounts[np.minimum(met, 3).astype(int)]) / np.maximum(total, 1)[of_first]
    chance = direct + share[of_first] * alone[word]
    return np.log10(chance), count[word]


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_tokens, n_known, base_score, score, perplexity)`` for every row of ``docs``.

    ``score`` is the log10 probability of the text and its end; ``base_score``
    that of single words with add-one smoothing, an unknown word being one more
    kind. A null text is an empty one and has its end only. Texts of any length
    are scored whole. Ids may be null or repeat; other columns are not read; an
    empty table gives an empty result.
    """
    # A path and a number per shard, sums of at most MOST_HOT words.
    held = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        whole = np.log10(float(model.tokens + model.kinds + 1))
        for batch in batches:
            for begun, some in blocks(batch.column("text")):
                tokens, begin, ends = _tokens(some)
                logs, count = log_probabilities(model, tokens, begin)
                n = ends - begin
                scores = np.add.reduceat(logs, begin)
                base = np.add.reduceat(np.log10(count + 1) - whole, begin)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(begun, len(some)),
                        pa.array(n, pa.int64()),
                        pa.array(np.add.reduceat((count > 0).astype(np.int64), begin)),
                        pa.array(base),
                        pa.array(scores),
                        pa.array(10 ** np.minimum(-scores / n, 300)),
                    ],
                    names=["id", "n_tokens", "n_known", "base_score", "score", "perplexity"],
                )

    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    kinds = "id bigint, n_tokens bigint, n_known bigint, base_score double, score double, perplexity double"
    return texts.mapInArrow(rows, kinds).withColumnRenamed("id", id_column)
