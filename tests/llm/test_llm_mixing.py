from collections import Counter, defaultdict

from llm_samples import documents, frame, words

from kimberlite.llm.mixing import mix


def want_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    rest, free, target = sum(sizes.values()), set(names), {}
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = most * sizes[s]
            rest -= target[s]
            free.discard(s)


def test_targets_sizes_and_words_taken(spark):
    rows = documents(n=400)
    # One source holds most rows, one is tiny and stops at three times its size.
    rows += [(2000 + i, "a few words here " * (i % 7), "en", "hot", 1, None, None, None) for i in range(600)]
    rows += [(9000, "tiny source", "en", "A", 1, None, None, None)]
    found = mix(frame(spark, rows)).collect()
    size = {(r[0], r[1], r[3]): len(words(r[1])) for r in rows}
    totals = Counter()
    for r in rows:
        totals[r[3]] += size[(r[0], r[1], r[3])]
    target, taken = want_targets(totals), defaultdict(int)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in found) == Counter(
        (r[0], r[3], size[(r[0], r[1], r[3])]) for r in rows
    )
    for r in found:
        assert r["source_size"] == totals[r["source"]]
        assert abs(r["target"] - target[r["source"]]) < 1e-6 * max(1, target[r["source"]])
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
    assert target["A"] == 6 and taken["A"] == 6
    for source, words_taken in taken.items():
        assert abs(words_taken - target[source]) <= max(10, 0.02 * target[source]), source


def test_a_document_larger_than_the_gap_does_not_end_the_filling(spark):
    # The long one ranks first by its preference and never fits; more than 1000 of the others must fill the gap.
    rows = [(i, "ten words " * 5 if i % 2 else "three words here", "en", "a", 1, None, 1, None) for i in range(6000)]
    rows += [(9000, "long " * 40_000, "en", "a", 1, None, 10**9, None), (9001, "word " * 41_000, "en", "b", 1, None, 1, None)]
    found = mix(frame(spark, rows), weights=(1, 4), preference_column="kept").collect()
    target = {r["source"]: r["target"] for r in found}["a"]
    taken = sum(r["copies"] * r["size"] for r in found if r["source"] == "a")
    assert 20_000 < target < 39_000 and abs(taken - target) <= 1.5
    assert not [r for r in found if r["doc_id"] == 9000 and r["copies"]]


def test_reruns_and_partitionings_agree(spark):
    rows = documents(n=100)
    one, two = (
        Counter(map(tuple, mix(frame(spark, r, parts=p)).collect())) for r, p in ((rows, 5), (rows[::-1], 2))
    )
    assert one == two


def test_preferred_documents_are_taken_more_often(spark):
    rows = [(i, "some words of text", "en", "ab"[i % 2], 1, None, i % 4 // 2 * 20 + 1, None) for i in range(400)]
    taken = Counter()
    for r in mix(frame(spark, rows), weights=(1, 3), preference_column="kept").collect():
        if r["source"] == "a":
            taken[rows[r["doc_id"]][6]] += r["copies"]
    assert taken[21] > 1.5 * taken[1]


def test_tables_without_rows_or_words(spark):
    assert mix(frame(spark, [])).count() == 0
    rows = [(1, "", "en", "a", 1, None, None, None), (2, None, "en", None, 1, None, None, None)]
    assert {(r["target"], r["copies"]) for r in mix(frame(spark, rows)).collect()} == {(0.0, 0)}
