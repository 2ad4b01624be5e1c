import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_samples import documents, frame, words

from kimberlite.llm import language_model as lm


def tokens(text):
    return [*words(text), "</s>"]


def discounts(counts):
    n = Counter(counts)
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
    out = [0]
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k + 1] / n[k] if n[k] and y else k / 2
        out.append(d if 0 < d < k else k / 2)
    return out


class Plain:
    def __init__(self, texts):
        self.count, pairs = Counter(), Counter()
        for text in texts:
            t = tokens(text)
            self.count.update(t)
            pairs.update(zip(["<s>", *t[:-1]], t))
        self.pairs, self.before = pairs, Counter(b for _, b in pairs)
        self.d2, self.d1 = discounts(pairs.values()), discounts(self.before.values())
        self.after = defaultdict(list)
        for (a, _), c in pairs.items():
            self.after[a].append(c)

    def word(self, w):
        total = len(self.pairs)
        if not total:
            return 1 / (len(self.count) + 1)
        rest = sum(self.d1[min(c, 3)] for c in self.before.values()) / total
        c = self.before[w]
        return (c - self.d1[min(c, 3)]) / total + rest / (len(self.count) + 1)

    def pair(self, a, b):
        if a not in self.after:
            return self.word(b)
        total, c = sum(self.after[a]), self.pairs[a, b]
        share = sum(self.d2[min(x, 3)] for x in self.after[a]) / total
        return (c - self.d2[min(c, 3)]) / total + share * self.word(b)

    def score(self, text):
        t = tokens(text)
        return sum(math.log10(self.pair(a, b)) for a, b in zip(["<s>", *t[:-1]], t))

    def base(self, text):
        whole = sum(self.count.values()) + len(self.count) + 1
        return sum(math.log10((self.count[w] + 1) / whole) for w in tokens(text))


def check(spark, train, rows, monkeypatch=None):
    model = lm.fit(frame(spark, train))
    plain = Plain([r[1] for r in train])
    assert model.tokens == sum(plain.count.values()) and model.kinds == len(plain.count)
    found = lm.score(frame(spark, rows), model).collect()
    assert len(found) == len(rows)
    want = defaultdict(list)
    for r in rows:
        t = tokens(r[1])
        want[r[0], len(t), sum(plain.count[w] > 0 for w in t)].append((plain.base(r[1]), plain.score(r[1])))
    for r in found:
        near = want[r["doc_id"], r["n_tokens"], r["n_known"]]
        assert any(
            r["base_score"] == pytest.approx(b, rel=1e-9, abs=1e-9) and r["score"] == pytest.approx(s, rel=1e-6, abs=1e-6)
            for b, s in near
        )
    return plain


def test_scores_are_those_of_a_plain_model(spark):
    rows = documents()
    check(spark, rows[::2], rows)


def test_many_shards_and_hot_first_words(spark, monkeypatch):
    # Settings are read where the model is planned, and sent along in its layout.
    monkeypatch.setattr(lm, "SHARD_TOKENS", 2000)
    monkeypatch.setattr(lm, "HOT_TOKENS", 50)
    rows = documents()
    rows += [(30_000 + i, "the " + " the ".join(f"t{i * j}" for j in range(40)), *[None] * 6) for i in range(40)]
    check(spark, rows, rows)


def test_probabilities_of_all_words_sum_to_one():
    plain = Plain(["a b a c", "b b a", "", "c a b d"])
    for first in ["<s>", "a", "b", "unseen"]:
        assert sum(plain.pair(first, w) for w in plain.count) + plain.pair(first, "new") == pytest.approx(1)


def test_without_training_rows(spark):
    model = lm.fit(frame(spark, []))
    found = {r["doc_id"]: r for r in lm.score(frame(spark, [(1, "a b", *[None] * 6)]), model).collect()}
    assert (found[1]["n_tokens"], found[1]["n_known"], found[1]["base_score"], found[1]["score"]) == (3, 0, 0, 0)
    assert lm.score(frame(spark, []), model).count() == 0


def test_packed_columns_come_back():
    first = np.sort(np.random.default_rng(1).integers(0, 2**48, 1000, dtype=np.uint64))
    second = np.arange(1000, dtype=np.uint32)
    one, two = lm._unpack(lm._pack(first, second), np.uint64, np.uint32)
    assert (one == first).all() and (two == second).all()
