import hashlib

import numpy as np

from kimberlite.llm.centroids import centroid_clusters, half_gaps, moved, nearest, shrinkage

SCHEMA = "vec_id bigint, embedding array<double>, cluster string, v int, n string"


def brute(rows, k, rounds):
    """Lloyd's algorithm on whole numbers, every distance computed."""
    v = [[int(np.floor(256 * x)) for x in r[1]] for r in rows]
    order = sorted(
        range(len(rows)),
        key=lambda i: (rows[i][0] is None, hashlib.sha256(f"2:{rows[i][0]}".encode()).hexdigest(), v[i]),
    )
    centres = [list(v[i]) for i in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(centres)) for p in v]

    for _ in range(rounds):
        best = assign()
        for j in range(len(centres)):
            mine = [p for p, (_, b) in zip(v, best) if b == j]
            if mine:
                centres[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return assign(), centres


def rows(n, size, spread, seed=1, large=1.0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(7, size))
    points = middles[rng.integers(0, 7, n)] + spread * rng.normal(size=(n, size))
    return [(i * 11 % 10007, [float(x * large) for x in p], "c", 1, "n") for i, p in enumerate(points)]


def check(found, given, k, rounds):
    best, centres = brute(given, k, rounds)
    got = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["distance"], r["cluster"], tuple(r["centroid"])) for r in found)
    want = sorted((r[0] is None, r[0] or 0, d, j, tuple(centres[j])) for r, (d, j) in zip(given, best))
    assert got == want
    inertia = {j: sum(d for d, b in best if b == j) for _, j in best}
    assert {(r["cluster"], r["cluster_inertia"]) for r in found} == set(inertia.items())
    assert {r["inertia"] for r in found} <= {sum(inertia.values())}


def test_same_clusters_as_a_full_comparison(spark):
    given = rows(900, 6, 0.15)
    given += [given[0]] * 40 + [(given[1][0], given[2][1], None, None, None), (None, given[3][1], None, None, None)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0] * 5, [0.0] * 7, [nan] + [0.0] * 5, [-inf] + [0.0] * 5, [None] + [0.0] * 5, [1e300] * 6]
    odd = [(50_000 + i, b, None, None, None) for i, b in enumerate(bad)]
    df = spark.createDataFrame(given + odd, SCHEMA).repartition(6)
    found = centroid_clusters(df, k=9, rounds=4, size=6).collect()
    check(found, given, 9, 4)
    # Bounds spare most vectors most comparisons.
    assert np.mean([r["n_scans"] for r in found]) < 3


def test_large_components_stay_exact(spark):
    given = rows(80, 3, 0.3, large=3e5)
    check(centroid_clusters(spark.createDataFrame(given, SCHEMA), k=5, rounds=3, size=3).collect(), given, 5, 3)


def test_few_vectors_and_none(spark):
    given = rows(4, 3, 0.3) + [(77, [0.5, 0.5, 0.5], None, None, None)]
    check(centroid_clusters(spark.createDataFrame(given, SCHEMA), k=40, size=3).collect(), given, 40, 5)
    alone = [given[0]]
    check(centroid_clusters(spark.createDataFrame(alone, SCHEMA), k=3, size=3).collect(), alone, 3, 5)
    same = [(i, [0.1, 0.2, 0.3], None, None, None) for i in range(30)]
    check(centroid_clusters(spark.createDataFrame(same, SCHEMA), k=4, size=3).collect(), same, 4, 5)
    empty = centroid_clusters(spark.createDataFrame([], SCHEMA), k=3, size=3)
    assert empty.count() == 0
    assert empty.columns == centroid_clusters(spark.createDataFrame(given, SCHEMA), k=2, size=3).columns


def test_text_ids(spark):
    given = [(f"v-{r[0]}", r[1]) for r in rows(50, 3, 0.2)]
    found = centroid_clusters(spark.createDataFrame(given, "vec_id string, embedding array<double>"), k=4, size=3)
    check(found.collect(), given, 4, 5)


def test_no_distance_shrinks_by_more_than_the_bound():
    rng = np.random.default_rng(5)
    tighter = []
    for _ in range(300):
        size = int(rng.integers(2, 5))
        centre = rng.normal(size=size) * rng.choice([0.2, 1, 5])
        before = rng.normal(size=(6, size)) * 3
        after = before + rng.normal(size=(6, size)) * rng.choice([0.01, 0.5, 3])
        radius = float(rng.uniform(0, 3))
        directions = rng.normal(size=(400, size))
        directions /= np.linalg.norm(directions, axis=1, keepdims=True)
        points = centre + directions * radius * rng.uniform(0, 1, (400, 1)) ** 0.3
        shrunk = np.linalg.norm(points[:, None] - before, axis=2) - np.linalg.norm(points[:, None] - after, axis=2)
        bound = shrinkage(centre, radius, before, after)
        assert (shrunk.max(axis=0) <= bound + 1e-12).all()
        tighter.append(bound.sum() / np.linalg.norm(after - before, axis=1).sum())
    assert np.mean(tighter) < 0.75  # of full drift


def test_bounds_hold_after_a_move():
    rng = np.random.default_rng(6)
    points = np.floor(rng.normal(size=(500, 4)) * 100)
    one = points[:8].copy()
    cluster, upper, lower, squared, _ = nearest(points, one, np.zeros(500, int), np.zeros(500), np.zeros(500), None, False)
    radius = np.array([upper[cluster == j].max() for j in range(8)])
    two = one + np.floor(rng.normal(size=one.shape) * 10)
    move = moved(one, two, radius)
    distance = np.linalg.norm(points[:, None] - two, axis=2)
    rows_ = np.arange(500)
    assert (distance[rows_, cluster] <= upper + move.drift[cluster] + 1e-6).all()
    distance[rows_, cluster] = np.inf
    assert (distance.min(axis=1) >= lower - move.loosening[cluster] - 1e-6).all()
    assert len(half_gaps(one)) == 8 and (move.loosening <= move.drift.max()).all()
