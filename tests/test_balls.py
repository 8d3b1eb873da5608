"""Dunn scores with pruned comparisons against all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import balls, cluster


def distance_of(name):
    def one(a, b):
        if name == "euclidean":
            return math.dist(a, b)
        if name == "manhattan":
            return sum(abs(x - y) for x, y in zip(a, b))
        return 1 - sum(x * y for x, y in zip(a, b)) / (math.hypot(*a) * math.hypot(*b))

    return one


def brute(rows, name):
    d = distance_of(name)
    rows = sorted({(str(label), tuple(v)) for label, v in rows if v is not None and None not in v and not any(map(math.isnan, v))})
    if name.startswith("cosine"):
        rows = [r for r in rows if any(r[1])]
    pairs = [(d(a[1], b[1]), a[0] == b[0]) for i, a in enumerate(rows) for b in rows[:i]]
    return min((x for x, same in pairs if not same), default=None), max((x for x, same in pairs if same), default=None), len(pairs)


def clusters(rng, count, spread):
    centres = [(rng.uniform(-90, 90), rng.uniform(-90, 90), 50 + 9 * k) for k in range(6)]
    return [(k % 6, [c + rng.gauss(0, spread) for c in centres[k % 6]]) for k in range(count)]


@pytest.mark.parametrize("distance", ["euclidean", "manhattan", "cosine_dissimilarity"])
@pytest.mark.parametrize("spread", [0.5, 60.0])
def test_dunn_equals_all_pairs(spark, monkeypatch, distance, spread):
    monkeypatch.setattr(balls, "BLOCK_ROWS", 20)
    monkeypatch.setattr(balls, "CHUNK_BALLS", 7)
    monkeypatch.setattr(balls, "ROUNDS", (2, 5, None))
    rng = random.Random(7)
    rows = clusters(rng, 420, spread)
    rows += [rows[3], rows[3], (9, [1.0, 2.0, 400.0]), (0, None), (1, [1.0, None, 2.0]), (2, [float("nan"), 0.0, 0.0]), (5, [0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "label int, v array<double>")
    got = cluster.dunn_details(frame, "v", "label", distance).first()
    closest, widest, pairs = brute(rows, distance)
    assert math.isclose(got["closest"], closest, rel_tol=1e-6, abs_tol=1e-12) and math.isclose(got["widest"], widest, rel_tol=1e-6)
    assert math.isclose(got["score"], closest / widest, rel_tol=1e-6, abs_tol=1e-12) and got["pairs"] == pairs
    if spread < 1:
        assert got["compared"] < pairs / 3


def test_dunn_without_pairs(spark):
    for rows in ([], [(1, [1.0])], [(1, [1.0]), (1, [1.0])], [(1, [1.0]), (2, [3.0])], [(1, [1.0]), (1, [3.0])], [(1, None)]):
        frame = spark.createDataFrame(rows, "label int, v array<double>")
        assert cluster.dunn(frame, "v", "label").first()["score"] == 0.0


def test_silhouette_estimate_is_within_its_bound(spark):
    rng = random.Random(11)
    rows = [(k, label, v) for k, (label, v) in enumerate(clusters(rng, 600, 9.0))] + [(900, 77, [0.0, 0.0, 0.0]), (901, 1, None)]
    frame = spark.createDataFrame(rows, "id int, label int, v array<double>")
    exact = cluster.silhouette(frame.where("v IS NOT NULL"), "v", "label").first()["score"]
    bounds = []
    for size in (60, 240):
        got = cluster.silhouette_estimate(frame, "v", "label", ["id"], sample_rows=size, seed=size).first()
        assert abs(got["score"] - exact) <= got["bound"] and size <= got["n_sampled"] <= size + 6 and got["n_rows"] == 600
        bounds.append(got["bound"])
    assert bounds[1] < bounds[0] / 1.9
    whole = cluster.silhouette_estimate(frame, "v", "label", ["id"], sample_rows=10_000).first()
    assert math.isclose(whole["score"], exact, rel_tol=1e-6) and whole["bound"] == 0.0
    assert cluster.silhouette_estimate(frame.where("label = 1"), "v", "label", ["id"]).first()["score"] == 0.0


def test_blocks_of_one_pivot_shrink_with_their_rows(spark, monkeypatch):
    monkeypatch.setattr(balls, "BLOCK_ROWS", 20)
    rng = random.Random(3)
    rows = [(k % 2, [rng.uniform(0, 50), 60.0 * (k % 2) + rng.uniform(0, 9)]) for k in range(1_200)]
    frame = spark.createDataFrame(rows, "label int, v array<double>")
    found = balls.extremes(frame, F.col("v"), F.col("label"), pivots=1)
    closest, widest, pairs = brute(rows, "euclidean")
    assert math.isclose(found.closest, closest) and math.isclose(found.widest, widest) and found.pairs == pairs
    assert found.compared < pairs / 4


def test_extreme_distance_without_cancellation():
    rng = np.random.default_rng(4)
    for shift, scale in ((0.0, 1.0), (1e6, 1e-3), (0.0, 1e-9), (1e200, 1e190)):
        x, y = shift + scale * rng.normal(size=(60, 5)), shift + scale * rng.normal(size=(40, 5))
        y[0] = x[0]
        d = balls.pair_distances(x, y, False)
        assert balls.extreme_distance(x, y, False, False, math.inf) == d.min() == 0.0
        assert balls.extreme_distance(x, y[1:], False, False, math.inf) == d[:, 1:].min()
        assert balls.extreme_distance(x, y, False, True, -1.0) == d.max()
        assert balls.extreme_distance(x, y, False, True, 2 * d.max()) == 2 * d.max()


def test_euclidean_silhouette_compares_no_pairs_of_one_cluster(spark, monkeypatch):
    frame = spark.createDataFrame([(1, [float(k)]) for k in range(9)] + [(None, [3.0])], "label int, v array<double>")
    monkeypatch.setattr(cluster, "_euclidean_points", lambda *a: pytest.fail("pairs of one cluster were compared"))
    assert cluster.silhouette(frame, "v", "label").first()["score"] == 0.0


def test_tiles_without_cancellation():
    rng = np.random.default_rng(6)
    for shift, scale in ((0.0, 1.0), (1e7, 1e-2), (0.0, 1e-9), (1e160, 1e158)):
        x, y = shift + scale * rng.normal(size=(30, 4)), shift + scale * rng.normal(size=(20, 4))
        y[:5] = x[:5]
        y[5] = x[5] * (1 + 1e-12)
        with np.errstate(over="ignore"):
            np.testing.assert_allclose(cluster._tile(x, y), balls.pair_distances(x, y, False), rtol=1e-8)


def test_nearest_pivots_by_a_product():
    rng = np.random.default_rng(9)
    rows, pivots = rng.normal(5, 3, (40_000, 3)), rng.normal(5, 3, (600, 3))
    found = balls.nearest_pivot(rows, pivots, False)
    away = np.sqrt(((rows - pivots[found]) ** 2).sum(axis=1))
    some = rng.choice(len(rows), 500, replace=False)
    assert away[some] == pytest.approx(balls.pair_distances(rows[some], pivots, False).min(axis=1))
    assert (balls.nearest_pivot(rows[some], pivots, True) == balls.pair_distances(pivots, rows[some], True).argmin(axis=0)).all()
    # Rows beyond the range of squares get some pivot.
    assert set(balls.nearest_pivot(np.array([[1e200] * 3, [-1e300] * 3]), pivots, False)) <= set(range(600))
