"""Toxic passages as maximum-scoring segments of words.

Words and their first letters (prefixes stand in for forms never seen) get
log-odds between toxic and other labelled documents, with Dirichlet priors in
proportion to their overall frequency; what counts is the lower end of their
confidence interval. A word scores its best log-odds less a small drift. A
linear scan finds all maximal segments; with the decay rate of segment scores in
texts that are not toxic, their number and height become the p-value of
extreme-value theory for the sum of the best r segments. A logistic curve turns
its logarithm into a probability. Decay and curve come from documents whose
words were not used for the log-odds that score them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kimberlite.llm.language import Letters, letters_of
from kimberlite.llm.words import blocks, mix
from kimberlite.sources.scratch import stage, staging

#: Letters of the prefixes that score beside the whole word.
PREFIXES = (4, 5, 6)
#: What an ordinary word costs a segment.
DRIFT = 0.25
#: Log-odds that a feature must surely have; only what is above them scores.
MARGIN = 1.0
#: Standard deviations from the log-odds to what counts of them.
_CAUTION = 1.65
#: Mass of the priors, as a share of what is counted.
_PRIOR_SHARE = 0.05
_MOST_ODDS = 10.0
_SALTS = {k: mix(np.array([k], np.uint64))[0] for k in (0, *PREFIXES)}


@dataclass
class Model:
    """Features' sorted hashes and scores, decay and curve."""

    hashes: np.ndarray
    scores: np.ndarray
    decay: float = 1.0
    log_k: float = 0.0
    bend: tuple[float, float] = (0.0, 1.0)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        low, slope = self.bend
        return 1 / (1 + np.exp(-np.clip(low + slope * evidence, -500, 500)))


def features(letters: Letters, which: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of words and hashes, for the whole words and for each prefix shorter than them."""
    begin, end = letters.start[which], letters.end[which]
    yield which, mix(letters.stretch(begin, end) ^ _SALTS[0])
    for k in PREFIXES:
        longer = end - begin > k
        yield which[longer], mix(letters.stretch(begin[longer], begin[longer] + k) ^ _SALTS[k])


def word_scores(model: Model, letters: Letters) -> np.ndarray:
    """The log-odds of each word: its best feature's, 0 if none is known.

    A word that repeats one of the two before it in its text tells nothing new and scores 0.
    """
    words = letters.words()
    _, first, place = np.unique(words, return_index=True, return_inverse=True)
    best = np.zeros(len(letters.start))
    if len(model.hashes):
        for which, hashes in features(letters, first):
            at = np.minimum(np.searchsorted(model.hashes, hashes), len(model.hashes) - 1)
            known = model.hashes[at] == hashes
            best[which[known]] = np.maximum(best[which[known]], model.scores[at[known]])
    scores = best[first][place]
    for back in (1, 2):
        scores[back:][(words[back:] == words[:-back]) & (letters.doc[back:] == letters.doc[:-back])] = 0
    return scores


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal segments of positive score: first, beyond, score; in linear time.

    Each keeps the sums before (L) and after (R) it, and which one held before it
    is the last with a smaller L. A new one follows these links to the last whose L
    is smaller than its own, and is joined with it if that one's R is smaller too.
    Where none has a smaller L, nothing later can join what is held.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    sums = np.r_[0.0, np.cumsum(scores)].tolist()
    done: list[tuple[int, int, float, float, int]] = []
    held: list[tuple[int, int, float, float, int]] = []
    for i in positive.tolist():
        first, beyond, low, high = i, i + 1, sums[i], sums[i + 1]
        j = len(held) - 1
        while True:
            while j >= 0 and held[j][2] >= low:
                j = held[j][4]
            if j < 0:
                done += held
                held = [(first, beyond, low, high, -1)]
                break
            if held[j][3] >= high:
                held.append((first, beyond, low, high, j))
                break
            first, low, link = held[j][0], held[j][2], held[j][4]
            del held[j:]
            j = link
    return [(a, b, r - low) for a, b, low, r, _ in done + held]


def evidence(model: Model, heights: list[float], n_words: int) -> float:
    """Minus the logarithm of the p-value of the best segments, for the number that tells most."""
    best, total = 0.0, 0.0
    size = model.log_k + math.log(max(2, n_words))
    for r, height in enumerate(sorted(heights, reverse=True), 1):
        total += model.decay * height - size
        if total > 0:
            log_p = -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r)
            best = max(best, -log_p)
    return best


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    most_documents: int = 20_000,
    most_features: int = 200_000,
) -> Model:
    """A model from the texts of labelled documents.

    At most ``most_documents`` labelled ids take part, those with the smallest
    hash; equal texts count once. Rows with a null id, label or text teach
    nothing; of repeated ids the largest label holds. The model keeps the
    ``most_features`` features that tell most. Without toxic documents, or
    without others, every text gets the same score, their smoothed share.
    """
    spark = docs.sparkSession
    drawn = (
        labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
        .filter("id is not null and label is not null")
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(most_documents)
    )
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).filter("text is not null")
    with staging(spark):
        sample = stage(
            texts.join(F.broadcast(drawn), "id")  # at most most_documents rows
            .select((F.col("label") > 0).cast("int").alias("label"), "text", F.xxhash64("text").alias("hash"))
            .dropDuplicates(["hash"])
            .select("label", "text", F.pmod("hash", F.lit(2)).cast("int").alias("side")),
            "labelled",
        )
        n_docs = {(r["label"], r["side"]): r["n"] for r in sample.groupBy("label", "side").agg(F.count(F.lit(1)).alias("n")).collect()}
        n = [sum(v for (label, _), v in n_docs.items() if label == y) for y in (0, 1)]
        if not min(n):
            share = (n[1] + 1) / (sum(n) + 2)
            return Model(np.empty(0, np.uint64), np.empty(0), bend=(math.log(share / (1 - share)), 0.0))
        counts = (
            sample.mapInArrow(_count, "hash bigint, n00 bigint, n01 bigint, n10 bigint, n11 bigint")
            .groupBy("hash")
            .agg(*[F.sum(c).alias(c) for c in ("n00", "n01", "n10", "n11")])
        )
        counts = stage(counts, "counts")
        sums = counts.agg(*[F.sum(c) for c in ("n00", "n01", "n10", "n11")]).first()
        # A feature that is rarer among toxic documents can't score.
        useful = counts.filter(
            f"(n10 + n11) * {sums[0] + sums[1]} > (n00 + n01) * {sums[2] + sums[3]} and n10 + n11 > 1"
        )
        top = useful.orderBy(F.desc(F.col("n10") + F.col("n11") - F.col("n00") - F.col("n01")), "hash").limit(most_features)
        rows = top.toArrow()
        hashes = rows.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        table = np.stack([rows.column(c).to_numpy() for c in ("n00", "n01", "n10", "n11")])[:, order].astype(float)
        hashes, sums = hashes[order], np.array([float(s) for s in sums])
        halves = [_scored(hashes, table[[s, 2 + s]], sums[[s, 2 + s]]) for s in (0, 1)]
        whole = _scored(hashes, table[:2], sums[:2], table[2:], sums[2:])
        _calibrate(sample, halves, n, whole)
    return whole


def _scored(hashes, table, sums, toxic=None, toxic_sums=None) -> Model:
    """Lower ends of the log-odds; counts of clean and toxic documents, in one or both halves."""
    if toxic is None:
        clean, bad, n_clean, n_bad = table[0], table[1], sums[0], sums[1]
    else:
        clean, bad, n_clean, n_bad = table.sum(0), toxic.sum(0), sums.sum(), toxic_sums.sum()
    prior, mass = _PRIOR_SHARE * (clean + bad + 1e-9), _PRIOR_SHARE * max(1.0, n_clean + n_bad)
    odds = np.log((bad + prior) / (n_bad + mass)) - np.log((clean + prior) / (n_clean + mass))
    spread = np.sqrt(1 / (bad + prior) + 1 / (clean + prior))
    score = np.minimum(odds - _CAUTION * spread - MARGIN, _MOST_ODDS)
    keep = score > DRIFT
    return Model(hashes[keep], score[keep])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of each label and side each feature occurs."""
    for batch in batches:
        cell = 2 * batch.column("label").to_numpy() + batch.column("side").to_numpy()
        for begun, some in blocks(batch.column("text")):
            letters = letters_of(some)
            every = np.arange(len(letters.start))
            doc, hashes = [], []
            for which, found in features(letters, every):
                doc.append(letters.doc[which])
                hashes.append(found)
            doc, hashes = np.concatenate(doc), np.concatenate(hashes)
            order = np.lexsort((doc, hashes))
            doc, hashes = doc[order], hashes[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
            doc, hashes = doc[new], hashes[new]
            kinds, at = np.unique(hashes, return_inverse=True)
            cells = cell[begun + doc]
            found = [np.bincount(at, weights=cells == c, minlength=len(kinds)).astype(np.int64) for c in range(4)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds.view(np.int64)), *map(pa.array, found)], names=["hash", "n00", "n01", "n10", "n11"]
            )


def _calibrate(sample: DataFrame, halves: list[Model], n: list[int], whole: Model) -> None:
    """Set ``whole``'s decay and curve; each half of the sample is scored by the other half's model."""
    held = sample.sparkSession.sparkContext.broadcast(halves)  # bounded by most_features

    def heights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            side = batch.column("side").to_numpy()
            for begun, some in blocks(batch.column("text")):
                letters = letters_of(some)
                rows = side[begun : begun + len(some)]
                scores = [word_scores(m, letters) for m in (held.value[1], held.value[0])]
                mine = np.where(rows[letters.doc] == 0, scores[0], scores[1]) - DRIFT
                first = np.searchsorted(letters.doc, np.arange(len(some) + 1))
                found = [mine[a:b] for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("label").slice(begun, len(some)),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array([np.round(f[f > 0], 2).tolist() for f in found], pa.list_(pa.float64())),
                        pa.array([[h for _, _, h in segments(f)] for f in found], pa.list_(pa.float64())),
                    ],
                    names=["label", "n_words", "words", "heights"],
                )

    scored = stage(
        sample.mapInArrow(heights, "label int, n_words bigint, words array<double>, heights array<double>"), "heights"
    )
    # What comes to the driver has a row per sampled document or rounded score at most.
    clean = scored.filter("label = 0")
    n_words = clean.agg(F.sum("n_words")).first()[0] or 1
    drawn = clean.select(F.explode("words").alias("s")).groupBy("s").count().collect()
    steps = np.array([r["s"] for r in drawn] + [_MOST_ODDS / 2])
    shares = np.array([r["count"] for r in drawn] + [1.0]) / (n_words + 1)
    whole.decay = _decay(steps, shares)
    peaks = clean.select(F.explode("heights").alias("h")).agg(F.count("h"), F.min("h")).first()
    least = peaks[1] or 1.0
    whole.log_k = min(0.0, max(-6.0, math.log((peaks[0] + 1) / n_words) + whole.decay * least))
    rows = scored.select("label", "n_words", "heights").toArrow()
    x = np.array([evidence(whole, h, m) for h, m in zip(rows.column("heights").to_pylist(), rows.column("n_words").to_pylist())])
    whole.bend = _curve(x, rows.column("label").to_numpy().astype(float))


def _decay(steps: np.ndarray, shares: np.ndarray) -> float:
    """The positive solution of E[exp(decay * score)] = 1, words of no feature scoring -DRIFT."""
    rest = 1 - shares.sum()
    low, high = 1e-3, 50.0
    for _ in range(80):
        middle = (low + high) / 2
        if rest * math.exp(-DRIFT * middle) + float((shares * np.exp(np.minimum(middle * steps, 700))).sum()) > 1:
            high = middle
        else:
            low = middle
    return low


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one variable with smoothed targets."""
    bad, good = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (bad + 1) / (bad + 2), 1 / (good + 2))
    w = np.array([math.log((bad + 1) / (good + 1)), 0.0])
    columns = np.stack([np.ones_like(x), x])
    loss = lambda w: float(np.sum(np.logaddexp(0, w @ columns) - target * (w @ columns))) + 1e-3 * w[1] ** 2
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(w @ columns, -500, 500)))
        slope = columns @ (p - target) + np.array([0.0, 2e-3 * w[1]])
        bend = (columns * (p * (1 - p) + 1e-9)) @ columns.T + np.diag([0.0, 2e-3])
        step = np.linalg.solve(bend, slope)
        size = 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return float(w[0]), max(0.0, float(w[1]))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, n_words, score, passages)`` for every row of ``docs``, from the text alone.

    ``score`` is the probability of being toxic. ``passages`` are the segments
    that alone are significant at 0.01: character range and score. Texts that are
    null, empty or without letters have no passages and the score of no evidence.
    Texts of any length are scanned whole. Ids may be null or repeat; other
    columns are not read; an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by fit's most_features
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for begun, some in blocks(batch.column("text")):
                letters = letters_of(some)
                scores = word_scores(model, letters) - DRIFT
                first = np.searchsorted(letters.doc, np.arange(len(some) + 1))
                x, passages = np.zeros(len(some)), []
                for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
                    found = segments(scores[a:b])
                    x[i] = evidence(model, [h for _, _, h in found], b - a)
                    passages.append(
                        [
                            {
                                "begin": int(letters.start[a + s] - letters.base[i]),
                                "end": int(letters.end[a + e - 1] - letters.base[i]),
                                "score": h,
                            }
                            for s, e, h in found
                            if evidence(model, [h], b - a) > -math.log(0.01)
                        ]
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(begun, len(some)),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(model.probability(x)),
                        pa.array(passages, kind),
                    ],
                    names=["id", "n_words", "score", "passages"],
                )

    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    out = "id bigint, n_words bigint, score double, passages array<struct<begin:bigint,end:bigint,score:double>>"
    return texts.mapInArrow(scan, out).withColumnRenamed("id", id_column)
