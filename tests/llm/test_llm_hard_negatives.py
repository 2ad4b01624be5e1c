import numpy as np
import pytest
from pyspark.sql import functions as F

import kimberlite.llm.hard_negatives as module
from kimberlite.llm.hard_negatives import hard_negatives

SCHEMA = "vec_id bigint, embedding array<double>, label string, score int, rank string, key string"


def brute(rows, is_anchor, k, scale=256):
    rows = sorted({(i, tuple(int(np.floor(scale * x)) for x in v), label) for i, v, label in rows})
    out = []
    for a, v, label in rows:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, w, m in rows if i != a)
        for p, positive, _ in [s for s in scored if s[2] == label][:k]:
            fit = [s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:k]
            out += [(a, positive, rank, i, -p, -s) for rank, (s, i, _) in enumerate(fit, 1)]
    return sorted(out)


def rows(n, size, spread, seed=2, large=1.0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(9, size))
    kind = rng.integers(0, 9, n)
    points = (middles[kind] + spread * rng.normal(size=(n, size))) * large
    label = np.where(rng.random(n) < 0.6, kind % 3, rng.integers(0, 4, n))
    return [(i, [float(x) for x in p], f"l{m}") for i, p, m in zip(range(n), points, label)]


def frame(spark, given):
    return spark.createDataFrame([(*r, 1, "r", "k") for r in given], SCHEMA).repartition(5)


@pytest.fixture(params=[2048, 60])
def blocks(request, monkeypatch):
    monkeypatch.setattr(module, "LEAST_BLOCK", request.param)
    monkeypatch.setattr(module, "MOST_BLOCK", request.param)
    monkeypatch.setattr(module, "CLUSTER_ANCHORS", 20)
    monkeypatch.setattr(module, "MEMBERS", 16)
    return request.param


def test_same_rows_as_a_full_comparison(spark, blocks):
    given = rows(1500, 6, 0.4)
    given += [(2000 + i, given[50][1], given[50][2]) for i in range(300)]  # copies of an anchor's vector
    given += [(3000 + i, given[50][1], "other") for i in range(300)]
    given += [given[3]] * 50 + [(given[7][0], given[8][1], "l1")]  # repeated rows, a repeated id
    given += [(4000, [0.0] * 6, "l1"), (4001, [0.0] * 6, "l2"), (4050, [0.0] * 6, "l2"), (4100, given[9][1], "alone")]
    nan = float("nan")
    odd = [(5000, None, "l1"), (5050, [nan] + [0.0] * 5, "l1"), (5100, [1.0] * 5, "l1"), (5150, given[0][1], None)]
    odd += [(None, given[0][1], "l1"), (5200, [None] + [1.0] * 5, "l1"), (5250, [1e300] * 6, "l1")]
    found = hard_negatives(frame(spark, given + odd), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.collect())) == brute(given, lambda i: i % 50 == 0, 5)


def test_large_components_stay_exact(spark, blocks):
    given = rows(300, 4, 0.4, large=1e5)
    found = hard_negatives(frame(spark, given), F.col("vec_id") % 10 == 0, positives=3, negatives=3)
    assert sorted(map(tuple, found.collect())) == brute(given, lambda i: i % 10 == 0, 3)


def test_walks_end_early_where_vectors_lie_in_groups(spark, monkeypatch):
    """A list is walked only as far as the bounds allow."""
    steps = []
    given = rows(4000, 8, 0.02)
    monkeypatch.setattr(module, "STEP", 64)
    size = 8
    found = np.array([[int(np.floor(256 * x)) for x in r[1]] for r in given], np.float64)
    import pyarrow as pa

    units = module._unit(found)
    centres = module._directions(units[::40], 9)
    cluster = (units[::40] @ centres.T).argmax(axis=1)
    angles = np.arccos(np.clip((units[::40] @ centres.T).max(axis=1), -1, 1))
    widest = np.array([angles[cluster == c].max() if (cluster == c).any() else 0 for c in range(9)])
    table = pa.table(
        {
            "block": pa.array([0] * 4000, pa.int32()),
            "id": pa.array([r[0] for r in given]),
            "label": pa.array([r[2] for r in given]),
            "v": pa.array([list(map(int, v)) for v in found], pa.list_(pa.int32())),
        }
    )
    block = module._Block.of(table, centres, widest, size, True)
    for c in range(9):
        order, bound = block.shared_list(c)
        assert (np.diff(bound) <= 0).all()
        lengths = np.linalg.norm(found[::40], axis=1)
        for a in np.flatnonzero(cluster == c):
            score = found[::40][a] @ found[order].T
            assert (score <= bound * lengths[a] + 1e-6).all()
            steps.append((bound * lengths[a] >= np.sort(score)[-6]).mean())
    assert np.mean(steps) < 0.4  # of the list


def test_no_anchors_and_no_rows(spark):
    given = rows(30, 3, 0.4)
    none = hard_negatives(frame(spark, given), F.col("vec_id") < 0)
    assert none.count() == 0 and none.columns == hard_negatives(frame(spark, given), F.col("vec_id") == 3).columns
    assert hard_negatives(frame(spark, []), F.col("vec_id") == 3).count() == 0
    alone = hard_negatives(frame(spark, given[:1]), F.col("vec_id") == 0)
    assert alone.count() == 0


def test_text_ids(spark):
    given = [(f"v{r[0]:03d}", r[1], r[2]) for r in rows(120, 3, 0.4)]
    df = spark.createDataFrame(given, "vec_id string, embedding array<double>, label string")
    found = hard_negatives(df, F.col("vec_id").endswith("0"))
    assert sorted(map(tuple, found.collect())) == brute(given, lambda i: i.endswith("0"), 5)
