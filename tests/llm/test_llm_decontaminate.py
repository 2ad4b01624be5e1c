import random
from collections import Counter, defaultdict

from llm_samples import ALPHANUMERIC, documents, frame, prose, words

from kimberlite.llm.decontaminate import contamination


def brute(docs, items, width=10):
    runs = defaultdict(set)
    for item, text in items:
        w = words(text, ALPHANUMERIC)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            runs[tuple(w[i : i + n])].add(item)
    out = []
    for row in docs:
        w = words(row[1], ALPHANUMERIC)
        hit, found = [False] * len(w), set()
        for n in {len(r) for r in runs}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in runs:
                    hit[i : i + n] = [True] * n
                    found |= runs[tuple(w[i : i + n])]
        out.append((row[0], len(w), sum(hit), tuple(sorted(str(i) for i in found if i is not None))))
    return out


def got(df):
    rows = df.collect()
    for r in rows:
        ends = [(s["first"], s["last"]) for s in r["spans"]]
        assert all(a[1] + 1 < b[0] for a, b in zip(ends, ends[1:]))
    return [
        (r["doc_id"], r["n_words"], sum(s["last"] - s["first"] + 1 for s in r["spans"]), tuple(r["items"])) for r in rows
    ]


def tables():
    rng = random.Random(4)
    docs = documents()
    items = [(i, prose(rng, rng.randrange(12, 60))) for i in range(20)]
    items += [(100, "short item here"), (101, ""), (102, None), (None, items[3][1]), (4, items[5][1]), (103, items[5][1])]
    items += [(104, "the " * 30), (105, "w1"), (106, prose(rng, 9))]
    for i, (_, text) in enumerate(items[:12]):  # whole items, their ends, nine words only
        part = [text, " ".join(text.split(" ")[2:]).upper().replace(" ", ", "), " ".join(text.split(" ")[:9])][i % 3]
        docs.append((5000 + i, prose(rng, 20) + " " + part + " " + prose(rng, 5), "en", "a", 1, None, None, None))
    docs.append((6000, "the " * 200 + "Short: ITEM, here!", "en", "a", 1, None, None, None))
    return docs, items


def test_hits_are_those_of_brute_force(spark):
    docs, items = tables()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = contamination(frame(spark, docs), bench)
    assert Counter(got(found)) == Counter(brute(docs, items))
    spans = {r["doc_id"]: r["spans"] for r in found.filter("doc_id = 5000").collect()}[5000]
    text = next(d[1] for d in docs if d[0] == 5000).encode()
    assert text[spans[0]["begin"] : spans[0]["end"]].decode().split(" ") == items[0][1].split(" ")


def test_empty_tables(spark):
    docs, items = tables()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert contamination(frame(spark, []), bench).count() == 0
    assert all(r["spans"] == [] for r in contamination(frame(spark, docs), none).collect())
