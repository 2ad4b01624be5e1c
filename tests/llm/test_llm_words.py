import random

import numpy as np
import pyarrow as pa
from llm_samples import ALPHANUMERIC, BLANK_SEPARATED, documents, words

from kimberlite.llm import words as w
from kimberlite.llm.rows import runs
from kimberlite.llm.superminhash import band_keys, signatures


def test_words_are_those_of_the_pattern():
    texts = [(r[1] or "").encode() for r in documents()]
    for table, pattern in ((w.BLANK_SEPARATED, BLANK_SEPARATED), (w.ALPHANUMERIC, ALPHANUMERIC)):
        found = w.words_of(texts, table)
        for i, text in enumerate(texts):
            mine = range(found.first[i], found.first[i + 1])
            got = [text[found.start[k] - found.base[i] : found.end[k] - found.base[i]].decode() for k in mine]
            assert [words(x, pattern)[0] for x in got] == words(text.decode(), pattern)


def test_equal_words_hash_equally_and_others_differ():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["The", "the", "tHe", "then", "he", "é", "É", "x" * k]) for k in range(50)).encode()]
    found = w.words_of(texts, w.BLANK_SEPARATED)
    seen = {}
    for word, value in zip(words(texts[0].decode()), found.hash):
        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
    exact = w.words_of([b"The the"], w.BLANK_SEPARATED, exact=True)
    assert exact.hash[0] != exact.hash[1]


def test_grams_depend_on_their_words_and_order_alone():
    found = w.words_of([b"a b c d", b"x a b c d", b"b a c d"], w.BLANK_SEPARATED)
    grams, inside = w.grams(found.hash, 3), w.starts_inside(found, 3)
    doc = found.doc[: len(grams)]
    by_doc = [grams[inside & (doc == i)].tolist() for i in range(3)]
    assert by_doc[0] == by_doc[1][1:] and not set(by_doc[0]) & set(by_doc[2])
    assert [len(x) for x in by_doc] == [2, 3, 2]


def test_long_texts_are_blocks_of_their_own():
    column = pa.array(["a" * 10, None, "b" * (w.BLOCK_BYTES + 5), "c"])
    got = list(w.blocks(column))
    assert [b for b, _ in got] == [0, 2, 3]
    assert sum((t for _, t in got), []) == [(x or "").encode() for x in column.to_pylist()]
    assert list(w.blocks(pa.array([], pa.string()))) == []


def test_signatures_estimate_similarity_and_are_those_of_single_elements():
    rng = np.random.default_rng(5)
    one = rng.integers(0, 2**63, 600, dtype=np.uint64)
    two = np.concatenate([one[:480], rng.integers(0, 2**63, 120, dtype=np.uint64)])
    places = 288
    got = signatures(np.concatenate([one, two, one[:1]]), np.array([600, 600, 0, 1]), places)
    assert abs((got[0] == got[1]).mean() - 480 / 720) < 0.12
    assert (got[2] == 2**64 - 1).all()
    # A set's signature is the smallest of its elements' own, which are permutations.
    single = signatures(one, np.ones(600, np.int64), places)
    assert (single.min(axis=0) == got[0]).all()
    assert all(sorted((s >> np.uint64(40)).tolist()) == list(range(places)) for s in single[:20])
    keys = band_keys(got, 48)
    assert (keys[0] == keys[1]).sum() == sum((got[0][i * 6 : i * 6 + 6] == got[1][i * 6 : i * 6 + 6]).all() for i in range(48))
    assert len(np.unique(keys[0])) == 48


def test_runs_cross_batches():
    batches = [pa.RecordBatch.from_pydict({"k": k, "v": k}) for k in ([1, 1], [], [1, 2], [2], [3, 4, 4])]
    batches[1] = batches[0].slice(0, 0)
    assert [r.column("k").to_pylist() for r in runs(iter(batches), ["k"])] == [[1, 1, 1], [2, 2], [3], [4, 4]]
