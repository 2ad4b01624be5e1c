"""Language of texts by known words first, then ever shorter character n-grams.

Words are runs of letters in lower case. The model holds, for the most frequent
words and n-grams, the logarithm of their frequency in each language. A known
word adds these logarithms. An unseen word is scored by the longest n-grams of
it, word ends included, of which any is known: their mean is what it adds.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kimberlite.llm.row_keys import told_apart
from kimberlite.llm.staged import broadcast_if_few
from kimberlite.llm.words import blocks, mix, power
from kimberlite.sources.scratch import stage, staging

UNKNOWN = "und"
#: Orders of character n-grams, tried in this order.
ORDERS = (4, 3, 2, 1)
_WORD = 0  # order of whole words in the model
_SMOOTH = 0.5
_tables: dict[str, np.ndarray] = {}


def _code_points() -> np.ndarray:
    """For each code point, its lower case, or 0 if it is no letter."""
    if not _tables:
        lower = np.zeros(sys.maxunicode + 1, np.uint32)
        for i in range(sys.maxunicode + 1):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                lower[i] = ord(low) if len(low) == 1 else i
        _tables["lower"] = lower
    return _tables["lower"]


@dataclass
class Letters:
    """Words of some texts as code points; ``gram`` hashes any stretch of them."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    sums: np.ndarray
    down: np.ndarray
    base: np.ndarray  # per text, where it begins
    n_docs: int

    def stretch(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.down[begin])

    def words(self) -> np.ndarray:
        return self.stretch(self.start, self.end)

    def grams(self, which: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of the words numbered ``which``, with both word ends if n > 1."""
        beyond = int(n > 1)
        begin, count = self.start[which] - beyond, self.end[which] - self.start[which] + 2 * beyond + 1 - n
        kept = count > 0
        which, begin, count = which[kept], begin[kept], count[kept]
        owner = np.repeat(which, count)
        first = np.repeat(begin - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(len(owner))
        return owner, self.stretch(first, first + n)


def letters_of(texts: list[bytes]) -> Letters:
    strings = [t.decode("utf-8", "replace") for t in texts]
    codes = np.frombuffer(("\n" + "\n".join(strings) + "\n").encode("utf-32-le", "replace"), np.uint32)
    lower = _code_points()[codes]
    letter = lower > 0
    edges = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    start, end = edges[0::2], edges[1::2]
    sums = np.zeros(len(lower) + 1, np.uint64)
    values = mix(lower.astype(np.uint64) + np.uint64(1))
    np.cumsum(values * power("up", len(lower)), out=sums[1:])
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    base = np.cumsum(lengths + 1) - lengths
    doc = np.searchsorted(base, start, side="right") - 1
    return Letters(start, end, doc, sums, power("down", len(lower) + 1), base, len(texts))


@dataclass
class Model:
    """Languages in order, and per order (0: words) sorted hashes and log frequencies."""

    languages: list[str]
    hashes: dict[int, np.ndarray]
    logs: dict[int, np.ndarray]

    def find(self, order: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known = self.hashes[order]
        if not len(known):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        return at, known[at] == hashes

    def evidence(self, letters: Letters) -> np.ndarray:
        """Sum of log frequencies per text and language."""
        total = np.zeros((letters.n_docs, len(self.languages)))
        at, known = self.find(_WORD, letters.words())
        self._add(total, letters.doc[known], self.logs[_WORD][at[known]])
        unseen = np.flatnonzero(~known)
        for order in ORDERS:
            if not len(unseen):
                break
            owner, hashes = letters.grams(unseen, order)
            at, found = self.find(order, hashes)
            owner, at = owner[found], at[found]
            seen, place, count = np.unique(owner, return_inverse=True, return_counts=True)
            logs = self.logs[order][at] / count[place][:, None]
            self._add(total, letters.doc[owner], logs)
            unseen = np.setdiff1d(unseen, seen, assume_unique=True)
        return total

    @staticmethod
    def _add(total: np.ndarray, doc: np.ndarray, logs: np.ndarray) -> None:
        for i in range(total.shape[1]):
            total[:, i] += np.bincount(doc, weights=logs[:, i], minlength=len(total))


def fit(
    labelled: DataFrame,
    text_column: str = "text",
    language_column: str = "lang",
    most_documents: int = 20_000,
    most_words: int = 200_000,
    most_grams: int = 50_000,
) -> Model:
    """A model from rows with text and language.

    Each different text of a language counts once, however many copies it has. Of
    each language at most ``most_documents`` divided by the number of languages
    are drawn, those with the smallest hashes, one at least, so that a rare
    language is learned beside a frequent one. The model keeps, over all
    languages, at most ``most_words`` words and ``most_grams`` n-grams of each
    order: the most frequent of each language in equal shares. Rows with a null
    text or language teach nothing.
    """
    spark = labelled.sparkSession
    usable = labelled.select(F.col(text_column).alias("text"), F.col(language_column).cast("string").alias("lang"))
    usable = usable.filter("text is not null and lang is not null")
    usable = usable.select("lang", F.xxhash64("text").alias("key_1"), F.xxhash64(F.lit(1), "text").alias("key_2"), "text")
    key = ["lang", "key_1", "key_2"]
    languages = sorted(r["lang"] for r in usable.select("lang").distinct().collect())
    share = max(1, most_documents // max(1, len(languages)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("key_1", "key_2"))
    chosen = usable.select(*key).distinct().withColumn("place", place).filter(F.col("place") <= share).drop("place")
    with staging(spark):
        chosen = broadcast_if_few(stage(chosen, "chosen"))
        texts = usable.join(chosen, key, "left_semi").groupBy(*key).agg(F.first("text").alias("text"))
        counted = texts.select("text", "lang").mapInArrow(_count, "lang string, place int, hash bigint, n bigint")
        counts = stage(counted.groupBy("lang", "place", "hash").agg(F.sum("n").alias("n")), "counts")
        sums = counts.groupBy("lang", "place").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()
        rank = F.row_number().over(Window.partitionBy("lang", "place").orderBy(F.desc("n"), "hash"))

        def top(which, most: int) -> DataFrame:
            return counts.filter(which).withColumn("rank", rank).filter(F.col("rank") <= most // max(1, len(languages)))

        word = F.col("place") == _WORD
        most = top(word, most_words).unionByName(top(~word, most_grams))
        rows = most.select("lang", "place", "hash", "n").toArrow()
    return _model(rows, languages, {(r["lang"], r["place"]): (r["n"], r["kinds"]) for r in sums})


def _model(rows: pa.Table, languages: list[str], sums: dict) -> Model:
    place = rows.column("place").to_numpy()
    hashes = rows.column("hash").to_numpy().view(np.uint64)
    number = {name: i for i, name in enumerate(languages)}
    lang = np.array([number[x] for x in rows.column("lang").to_pylist()], np.int64)
    n = rows.column("n").to_numpy()
    model = Model(languages, {}, {})
    for order in (_WORD, *ORDERS):
        mine = place == order
        kept, at = np.unique(hashes[mine], return_inverse=True)
        counts = np.zeros((len(kept), len(languages)))
        counts[at, lang[mine]] = n[mine]
        kinds = sum(sums.get((x, order), (0, 0))[1] for x in languages)
        whole = np.array([sums.get((x, order), (0, 0))[0] for x in languages], float)
        model.hashes[order] = kept
        model.logs[order] = np.log((counts + _SMOOTH) / (whole + _SMOOTH * (kinds + 1))).astype(np.float32)
    return model


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.column("lang").to_pylist()
        languages = sorted(set(names))
        number = {name: i for i, name in enumerate(languages)}
        for begun, some in blocks(batch.column("text")):
            letters = letters_of(some)
            lang = np.array([number[x] for x in names[begun : begun + len(some)]], np.int64)
            every = np.arange(len(letters.start))
            for order in (_WORD, *ORDERS):
                owner, hashes = (every, letters.words()) if order == _WORD else letters.grams(every, order)
                mine = lang[letters.doc[owner]]
                for i in np.unique(mine):
                    kinds, count = np.unique(hashes[mine == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([languages[i]] * len(kinds), pa.string()),
                            pa.array(np.full(len(kinds), order, np.int32)),
                            pa.array(kinds.view(np.int64)),
                            pa.array(count, pa.int64()),
                        ],
                        names=["lang", "place", "hash", "n"],
                    )


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, text_hash, lang_pred, score)`` for every row of ``docs``, from the text alone.

    ``score`` is the language's share of the likelihood, all languages being
    equally likely before. A text that is null or has no letter is ``und`` with
    score 0, as is any text if the model knows no language. A text of which
    nothing is known gets the first language with an equal share. Rows without an
    id and rows that repeat one are predicted as any other; other columns are not
    read; an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the parameters of fit

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for begun, some in blocks(batch.column("text")):
                letters = letters_of(some)
                best, score = np.zeros(len(some), np.int64), np.zeros(len(some))
                has_letters = np.bincount(letters.doc, minlength=len(some)) > 0
                if model.languages:
                    total = model.evidence(letters)
                    total -= total.max(axis=1, keepdims=True)
                    best = total.argmax(axis=1)
                    score = 1 / np.exp(total).sum(axis=1)
                else:
                    has_letters[:] = False
                names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letters)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(begun, len(some)),
                        batch.column("text_hash").slice(begun, len(some)),
                        pa.array(names, pa.string()),
                        pa.array(np.where(has_letters, score, 0.0)),
                    ],
                    names=["id", "text_hash", "lang_pred", "score"],
                )

    texts = told_apart(docs, id_column, text_column)
    out = "id bigint, text_hash bigint, lang_pred string, score double"
    return texts.mapInArrow(guess, out).withColumnRenamed("id", id_column)
