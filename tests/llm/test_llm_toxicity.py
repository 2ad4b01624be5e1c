import random

import numpy as np
import pytest
from llm_samples import documents, frame, prose

from kimberlite.llm import toxicity

def words(rng, n):
    """Words of letters, of which there are many."""
    return prose(rng, n, 3000).translate(str.maketrans("0123456789", "abcdefghij")).split(" ")


BAD = ["vilk", "grob", "snarl", "mork"]


def brute_segments(scores):
    """All maximal segments, by their definition: best segment, then both sides of it."""
    best = max(
        ((sum(scores[a:b]), -(b - a), a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
        default=(0,),
    )
    if best[0] <= 0:
        return []
    _, _, a, b = best
    right = [(x + b, y + b, s) for x, y, s in brute_segments(scores[b:])]
    return brute_segments(scores[:a]) + [(a, b, best[0])] + right


def test_segments_take_linear_time():
    """Sparse hits among falling sums, and rising ones: four times the length, about four times the time."""
    import time

    for step, after in ((1.0, -1.5), (1.0, -0.5), (0.5, -0.4)):
        taken = []
        for n in (20_000, 80_000):
            scores = np.tile([step, after], n // 2)
            begun = time.process_time()
            toxicity.segments(scores)
            taken.append(time.process_time() - begun)
        assert taken[1] < 10 * taken[0] + 0.1 and taken[1] < 5


def test_segments_are_all_maximal_ones():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 14, 24):
        for _ in range(20):
            scores = np.round(rng.normal(-0.2, 1, n), 3)
            got = toxicity.segments(scores)
            want = brute_segments(scores.tolist())
            assert [g[:2] for g in got] == [w[:2] for w in want]
            assert np.allclose([g[2] for g in got], [w[2] for w in want])


def rows_and_labels(n=600):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        text, toxic = words(rng, rng.randrange(20, 150)), i % 6 == 0
        for _ in range(rng.randrange(3, 6) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(BAD) + rng.choice(["", "a", "en", "ito"]))
        rows.append((i, " ".join(text), None, None, None, None, None, None))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = rows_and_labels()
    odd = [(None, 1, 1), (5000, 1, 1), (3, None, None), (6, 0, 0), (6, 0, 1)]
    table = spark.createDataFrame(labels[:400] + odd, "doc_id bigint, quality int, toxic int")
    return toxicity.fit(frame(spark, rows), table)


def test_held_out_documents(spark, model):
    rows, labels = rows_and_labels()
    held = {r["doc_id"]: r for r in toxicity.score(frame(spark, rows[400:]), model).collect()}
    wrong = [i for i, _, toxic in labels[400:] if (held[i]["score"] >= 0.7) != bool(toxic)]
    assert len(wrong) <= 4
    for i, _, toxic in labels[400:]:
        for p in held[i]["passages"]:
            assert any(b in rows[i][1][p["begin"] : p["end"]] for b in BAD)
        assert bool(held[i]["passages"]) == bool(toxic) or i in wrong


def test_a_short_passage_in_a_very_long_text_and_odd_texts(spark, model):
    rng = random.Random(5)
    long = words(rng, 15_000)
    clean, long[7000:7000] = " ".join(long), ["vilka", "grob", "mork", "snarlen"]
    rows = [*documents(), (700_001, clean, *[None] * 6), (700_002, " ".join(long), *[None] * 6)]
    found = toxicity.score(frame(spark, rows), model).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[700_001]["score"] < 0.5 < 0.9 < by_id[700_002]["score"]
    assert all(0 <= r["score"] <= 1 for r in found)
    none = {r["score"] for r in found if not r["n_words"]}
    assert len(none) == 1 and none.pop() < 0.5


def test_scores_depend_on_neither_copies_nor_order_of_rows(spark, model):
    rng = random.Random(4)
    texts = ["vilk", "grob vilk", "vilk grob", "snarl mork vilk", "vilk", "", "mork " + " ".join(words(rng, 30)) + " vilk"]
    rows = [(i, texts[i % len(texts)] if i % 50 else None, *[None] * 6) for i in range(300)]
    rows += [(300 + i, "vilk grob", *[None] * 6) for i in range(100)]  # side by side
    found = []
    for some, parts in ((rows, 1), (rows[::-1], 1), (rng.sample(rows, len(rows)), 3)):
        found.append({r["doc_id"]: (r["score"], r["passages"]) for r in toxicity.score(frame(spark, some, parts=parts), model).collect()})
    assert found[0] == found[1] == found[2]
    by_text = {}
    for i, text, *_ in rows:
        by_text.setdefault(text or "", set()).add(found[0][i][0])
    assert all(len(s) == 1 for s in by_text.values())
    assert by_text["vilk grob"] != by_text[""]


def test_without_rows_or_labels(spark, model):
    assert toxicity.score(frame(spark, []), model).count() == 0
    none = toxicity.fit(frame(spark, documents()), spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert {r["score"] for r in toxicity.score(frame(spark, documents()), none).collect()} == {0.5}
