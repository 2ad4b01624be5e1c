import numpy as np

from kimberlite.llm.vector_dups import Index, near_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, n string"


def vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(600, 16))
    near = [base[i] + rng.normal(size=16) * s for i in range(60) for s in (0.05, 0.15, 0.25)]
    crowd = base[599] + rng.normal(size=(700, 16)) * 0.12
    rows = [[float(np.float32(x)) for x in v] for v in [*base, *near, *crowd]]
    return rows + [rows[0]] * 5 + [[2 * x for x in rows[1]]]


def brute(rows):
    v = np.array([r[1] for r in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    links = (v @ v.T) >= 0.9
    np.fill_diagonal(links, False)
    label = np.array([r[0] for r in rows])
    while True:
        new = np.minimum(label, np.where(links, label[None, :], 2**60).min(axis=1))
        if (new == label).all():
            return links.sum(axis=1), label
        label = new


def test_links_and_components_against_brute_force(spark):
    good = [(i * 13 % 10007, v, 1, "x", "y") for i, v in enumerate(vectors())]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0] * 16, [1.0] * 15, [nan] + [1.0] * 15, [inf] + [1.0] * 15, [None] + [1.0] * 15]
    odd = [(20_000 + i, v, None, None, None) for i, v in enumerate(bad)] + [(None, good[0][1], 1, None, None)]
    found = near_vectors(spark.createDataFrame(good + odd, SCHEMA).repartition(6)).collect()
    assert len(found) == len(good) + len(odd)
    n_links, component = brute(good)
    by_id = {r["vec_id"]: r for r in found}
    got = np.array([by_id[r[0]]["n_links"] for r in good])
    assert (got <= n_links).all() and got.sum() >= 0.99 * n_links.sum()
    same = np.mean([by_id[r[0]]["component_id"] == c for r, c in zip(good, component)])
    assert same >= 0.99
    for r in found:
        assert r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"])
    for i, *_ in odd[:-1]:
        assert (by_id[i]["n_links"], by_id[i]["component_id"]) == (0, i)
    assert (by_id[None]["n_links"], by_id[None]["component_id"]) == (0, None)


def test_cells_are_visited_by_distance():
    rng = np.random.default_rng(2)
    for visits in (1, 2, 5, 20, 49, 60):
        index = Index(rng.normal(size=(7, 4)), rng.normal(size=(7, 4)), visits=visits)
        left, right = index.distances(rng.normal(size=(30, 8)))
        grid = (left[:, :, None] + right[:, None, :]).reshape(30, -1)
        cells = index.nearest_cells(left, right)
        assert (cells == np.argsort(grid, axis=1, kind="stable")[:, :visits]).all()
        rank = index.rank(left, right, cells[:, -1])  # rounding may count the cell itself
        assert ((rank == cells.shape[1]) | (rank == cells.shape[1] + 1)).all()


def test_rare_links_are_found(spark):
    """Twenty pairs at cosine 0.92 among vectors that lie evenly; the probes see next to none."""
    rng = np.random.default_rng(8)
    n, size = 12_000, 64
    v = rng.normal(size=(n, size))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    for k in range(20):
        aside = rng.normal(size=size)
        aside -= aside @ v[k] * v[k]
        v[n - 1 - k] = 0.92 * v[k] + (1 - 0.92**2) ** 0.5 * aside / np.linalg.norm(aside)
    rows = [(i, [float(np.float32(x)) for x in r]) for i, r in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(8)
    found = near_vectors(df, most_sampled=4096, probes=512).filter("n_links > 0").collect()
    linked = {r["vec_id"]: r["component_id"] for r in found}
    assert all(linked[i] in (i, n - 1 - i) for i in linked)
    assert len(linked) >= 0.9 * 40


def test_rows_of_one_id_are_judged_each_by_its_own_vector(spark):
    one, two = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [("e", one), ("e", two), ("f", [0.99, 0.01, 0.0]), ("g", [0.01, 0.99, 0.0]), ("h", two)]
    found = near_vectors(spark.createDataFrame(rows, "vec_id string, embedding array<double>")).collect()
    assert sorted(map(tuple, found)) == sorted(
        [("e", 1, "e", True), ("e", 2, "e", True), ("f", 1, "e", False), ("g", 2, "e", False), ("h", 2, "e", False)]
    )


def test_an_empty_table_and_one_without_vectors(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = near_vectors(spark.createDataFrame([(1, None, 1, None, None), (2, [1.0], 1, None, None)], SCHEMA))
    assert {tuple(r) for r in alone.collect()} == {(1, 0, 1, True), (2, 0, 2, True)}
