import random
from collections import Counter, defaultdict

from llm_samples import documents, edited, frame, prose, words

from kimberlite.llm.graph import components
from kimberlite.llm.near_dups import near_duplicates


def shingles(text, n):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(rows, n, percent):
    """Size, component of each row; classes of equal sets are named by their smallest id."""
    sets = [shingles(r[1], n) for r in rows]
    named = defaultdict(list)
    for row, s in zip(rows, sets):
        if row[0] is not None and s:
            named[s].append(row[0])
    node = {s: min(ids) for s, ids in named.items()}
    parent = {i: i for i in node.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    every = list(node)
    for i, a in enumerate(every):
        for b in every[:i]:
            common = len(a & b)
            if 100 * common >= percent * (len(a) + len(b) - common):
                x, y = root(node[a]), root(node[b])
                parent[max(x, y)] = min(x, y)
    out = []
    for row, s in zip(rows, sets):
        component = None if row[0] is None else root(node[s]) if s else row[0]
        out.append((row[0], len(s), component, row[0] is None or component == row[0]))
    return out


def got(df):
    return [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()]


def test_components_are_those_of_brute_force(spark):
    rows = documents()
    assert Counter(got(near_duplicates(frame(spark, rows), shingle_words=4))) == Counter(brute(rows, 4, 80))


def test_a_large_group_of_near_copies_and_a_shared_passage(spark):
    rng = random.Random(9)
    base, passage = prose(rng, 80, 10**6), prose(rng, 60, 10**6)
    texts = [edited(rng, base, rng.randrange(0, 9)) for _ in range(300)]
    texts += [prose(rng, 30, 10**6) + " " + passage + " " + prose(rng, rng.randrange(3, 40), 10**6) for _ in range(300)]
    texts += [base] * 100
    rows = [(i, t, None, None, None, None, None, None) for i, t in enumerate(texts)]
    assert Counter(got(near_duplicates(frame(spark, rows)))) == Counter(brute(rows, 5, 80))


def test_an_empty_table(spark):
    assert near_duplicates(frame(spark, [])).count() == 0


def test_components_of_paths_stars_and_odd_edges(spark):
    path = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    odd = [(7000, 7000), (None, 3), (8001, 8000), (8000, 8001)]
    found = components(spark.createDataFrame(path + star + odd, "a bigint, b bigint")).collect()
    want = {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)} | {8000: 8000, 8001: 8000}
    assert {r["node"]: r["component"] for r in found} == want and len(found) == len(want)
