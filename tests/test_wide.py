"""Many columns, many centres, and words beside apostrophes."""

import random

import numpy as np
import regex
from pyspark.sql import functions as F

from tidemark.functions import text as t
from tidemark.operators import cluster, decompose
from tidemark.session import SINGLE_TASK_ROWS_KEY


def test_covariance_of_many_columns_in_one_scan(spark):
    """Pairs of columns over the rows that have both, far from zero and with tasks that see nothing."""
    rng = np.random.default_rng(6)
    values = rng.normal(size=(150, 90)) @ rng.normal(size=(90, 90)) + 1e6
    values[rng.random(values.shape) < 0.1] = np.nan
    values[:, 7], values[1:, 8], values[:, 9] = np.nan, np.nan, 3.0
    names = [f"k{j}" for j in range(90)]
    rows = [tuple(None if np.isnan(x) and i % 2 else float(x) for x in row) for i, row in enumerate(values)]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r[0], r[1]): r[2] for r in decompose.covariance_table(frame, names).collect()}
    assert len(got) == 90 * 90
    for a in range(0, 90, 3):
        for b in range(90):
            both = ~np.isnan(values[:, a]) & ~np.isnan(values[:, b])
            if both.sum() < 2:
                assert got[names[a], names[b]] is None
            else:
                want = np.cov(values[both, a], values[both, b])[0, 1]
                assert abs(got[names[a], names[b]] - want) < 1e-6 * (1 + abs(want))
    assert {r[2] for r in decompose.covariance_table(frame.limit(0), names[:2]).collect()} == {None}


def test_seeding_many_centres_in_few_passes(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = np.array([(40.0 * (c % 15), 40.0 * (c // 15)) for c in range(120)])
    points = centres[rng.integers(0, 120, 1500)] + rng.normal(size=(1500, 2))
    rows = [([float(x) for x in p],) for p in points] + [([0.0, 0.0],)] * 50 + [(None,), ([1.0, None],)]
    frame = spark.createDataFrame(rows, "v array<double>")
    passes, plain = [], cluster.nearest_centre
    monkeypatch.setattr(cluster, "nearest_centre", lambda *a, **k: passes.append(1) or plain(*a, **k))
    for distance in ("euclidean", "manhattan"):
        found = cluster.spread_start(frame, "v", 120, 1, distance)
        assert found == cluster.spread_start(frame, "v", 120, 1, distance)
        near = np.abs(centres[:, None] - np.array(found)[None]).sum(axis=2).min(axis=1)
        assert len(found) == 120 and len({tuple(c) for c in found}) == 120 and (near < 12).mean() > 0.9
    assert len(passes) <= 4 * (cluster.SEED_ROUNDS + 1)
    assert len(cluster.spread_start(frame.limit(3), "v", 10, 1, "euclidean")) <= 3
    assert cluster.spread_start(frame.where("v IS NULL"), "v", 2, 1, "euclidean") == []


def test_contractions_by_the_definition(spark):
    """Every token between characters that end words is looked up as a whole."""
    rng = random.Random(4)
    words = t.contraction_words()
    pool = [*rng.sample(sorted(words), 40), "well", "don't've", "xdon't", "DON’T", "It’s", "cannot", "'s", "", "ünot", "id", "i'd"]
    texts = ["".join(rng.choice(pool) + rng.choice([" ", ", ", "'", "’", "-", "_", "!\n", "é", ". "]) for _ in range(rng.randrange(12))) for _ in range(400)]

    def expanded(token):
        full = words.get(token.replace("’", "'").lower())
        if full is None:
            return token
        if len(token) > 1 and token == token.upper():
            return full.upper()
        return full[0].upper() + full[1:] if token[0] == token[0].upper() else full

    token = regex.compile(r"[\p{L}\p{N}_]+(?:['’][\p{L}\p{N}_]+)*|[^\p{L}\p{N}_]+")
    rows = spark.createDataFrame([(x,) for x in [*texts, "", None]], "x string").select("x", t.expand_contractions("x").alias("y")).collect()
    for r in rows:
        assert r["y"] == (None if r["x"] is None else "".join(map(expanded, token.findall(r["x"]))))


def test_windows_of_a_periodogram(spark):
    """Named windows and weights against the transform of the weighted series."""
    from tidemark.operators import spectral

    rng = np.random.default_rng(8)
    x = rng.normal(size=40)
    frame = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, v double")
    t = np.arange(40) / 40
    shapes = {name: sum((-1) ** k * a * np.cos(2 * np.pi * k * t) for k, a in enumerate(c)) for name, c in spectral.COSINE_WINDOWS.items()}
    shapes["bartlett"] = 1 - np.abs(2 * t - 1)
    weights = rng.random(30)
    for window in ("hamming", "blackman", "flattop", "bartlett", [float(w) for w in weights]):
        w = shapes[window] if isinstance(window, str) else weights
        want = np.abs(np.fft.rfft(x[:len(w)] * w)) ** 2 / (w ** 2).sum()
        want[1:len(w) // 2] *= 2
        got = {r["bin"]: r["power"] for r in spectral.periodogram(frame, "v", [], ["i"], window=window).collect()}
        assert np.allclose([got[k] for k in range(len(want))], want, rtol=1e-6, atol=1e-9)


def test_sparse_indicators(spark):
    from tidemark.operators import encode
    from tidemark.session import stored

    frame = spark.createDataFrame([(0, "b"), (1, "a"), (2, None), (3, "c"), (4, "b")], "i int, v string")
    codes = stored(encode.sorted_codes(frame, ["v"]))
    more = frame.unionByName(spark.createDataFrame([(5, "new")], "i int, v string"))
    for drop, b, size in ((True, [0], 2), (False, [1], 3)):
        coded = encode.one_hot_sparse(more, "v", codes, "x", drop)
        got = {r["i"]: r["x"] for r in coded.collect()}
        assert (got[0]["size"], got[0]["indices"], got[0]["values"]) == (size, b, [1.0]) and got[2] is None
        assert got[1]["indices"] == ([] if drop else [0]) and got[5]["size"] is None and got[5]["indices"] == []
        back = {r["i"]: r["y"] for r in encode.one_hot_sparse_inverse(coded, "x", "v", codes, "y", drop).collect()}
        assert back == {0: "b", 1: "a", 2: None, 3: "c", 4: "b", 5: None}


def test_many_unequal_weights(spark):
    """Ten thousand weights by blocks against direct sums, for a long series, a short one and one with gaps."""
    from tidemark.operators import ordered

    rng = np.random.default_rng(9)
    series = {"long": rng.normal(size=12_500), "short": rng.normal(size=40), "gaps": np.where(rng.random(900) < 0.7, np.nan, rng.normal(size=900)), "none": np.full(5, np.nan)}
    rows = [(k, i, None if np.isnan(x) else float(x)) for k, v in series.items() for i, x in enumerate(v)]
    frame = spark.createDataFrame(rows, "k string, i int, v double").repartition(4)
    for length, rows_per_task in ((65, "300"), (65, None), (10_000, None)):
        # Also for series cut into chunks.
        spark.conf.set(SINGLE_TASK_ROWS_KEY, rows_per_task) if rows_per_task else spark.conf.unset(SINGLE_TASK_ROWS_KEY)
        weights = rng.random(length) + 0.1
        before = length // 2
        got = {(r["k"], r["i"]): r["m"] for r in ordered.moving_average(frame, "v", ["k"], ["i"], [float(w) for w in weights], "m").collect()}
        assert len(got) == len(rows)
        for k, v in series.items():
            for i in range(0, len(v), 97 if k == "long" else 1):
                near = np.arange(max(0, i - before), min(len(v), i - before + length))
                x, w = v[near], weights[near - i + before]
                there = ~np.isnan(x)
                want = (w[there] * x[there]).sum() / w[there].sum() if there.any() else None
                assert got[k, i] is None if want is None else abs(got[k, i] - want) < 1e-9


def test_a_round_of_kmeans_is_one_job(spark, monkeypatch):
    """Every round reads the matrices held by the first; before, it aggregated the source's rows anew."""
    rng = np.random.default_rng(2)
    frame = spark.createDataFrame([(list(map(float, r)),) for r in rng.normal(size=(300, 3))], "v array<double>")
    rounds, kept = [], cluster._round
    monkeypatch.setattr(cluster, "_round", lambda held, *a: rounds.append((held.id(), held.is_cached)) or kept(held, *a))
    centres = cluster.kmeans_fit(frame, "v", 6, distance="manhattan", seed=1)
    assert len(rounds) > 2 and len(set(rounds)) == 1 and rounds[0][1]
    labelled = cluster.assign_clusters(frame, "v", centres, "manhattan")
    _, means = cluster.centre_list(labelled, "v", "cluster")
    assert np.allclose(means, centres)


def test_kmeans_rounds_between_jobs(spark, monkeypatch):
    """Rounds in which only rows near a border can move need no job; before, every round was one. The centres are
    those of plain Lloyd rounds over all rows."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, 4)) + 5.0
    x[:5] = x[5]
    frame = spark.createDataFrame([(list(map(float, r)),) for r in x], "v array<double>")
    jobs, kept = [], cluster._round
    monkeypatch.setattr(cluster, "_round", lambda *a: jobs.append(1) or kept(*a))
    for distance in ("euclidean", "manhattan", "cosine_similarity"):
        jobs.clear()
        got = np.array(cluster.kmeans_fit(frame, "v", 3, "random", distance=distance, seed=4))
        centres, rounds, label = np.array(cluster.random_start(frame, "v", 3, 4)), 0, None
        while True:
            new = cluster._distances(x, centres, distance).argmin(axis=1)
            rounds += 1
            if label is not None and (new == label).all():
                break
            label = new
            centres = np.array([x[label == i].mean(axis=0) for i in range(3)])
        assert np.allclose(got, centres, atol=1e-9)
        assert len(jobs) < rounds * 0.7


def test_nearest_centres_and_margins():
    """Ties, rows without direction, rows far from zero and infinite distances, as the measured distances have them."""
    rng = np.random.default_rng(3)
    for distance in ("euclidean", "manhattan", "cosine_similarity"):
        for shift, scale in ((0.0, 1.0), (1e7, 1.0), (0.0, 1e-150), (0.0, 1e200)):
            x, c = rng.normal(size=(200, 5)) * scale + shift, rng.normal(size=(4, 5)) * scale + shift
            c[3], x[0], x[1] = c[2], 0.0, c[2]
            with np.errstate(all="ignore"):
                d = cluster._distances(x, c, distance)
                d = np.where(np.isnan(d), np.inf, d)
                label, margin = cluster._nearest(x, c, distance)
                assert (label == d.argmin(axis=1)).all()
                two = np.sort(d, axis=1)
                gap = np.where(np.isinf(two[:, 0]), 0.0, two[:, 1] - two[:, 0])
                some = np.arange(len(x)) > 0
                assert (margin[some] <= np.maximum(gap[some], 0.0) * (1 + 1e-9)).all()
                assert distance != "euclidean" or scale != 1.0 or shift or (margin[some] > 0.9 * gap[some] - 1e-9).all()


def test_cosine_units_are_made_once(spark, monkeypatch):
    """One pass sums the unit vectors; before, two did, and each took a row's length anew for every element."""
    rng = np.random.default_rng(8)
    rows = [(list(map(float, v)), i % 3) for i, v in enumerate(rng.normal(size=(60, 7)))] + [(None, 1), ([0.0] * 7, 2)]
    frame = spark.createDataFrame(rows, "v array<double>, l int")
    passes, kept = [], cluster.update_centres
    monkeypatch.setattr(cluster, "update_centres", lambda *a: passes.append(1) or kept(*a))
    got = cluster.silhouette(frame, "v", "l", "cosine_similarity").first()[0]
    assert len(passes) == 1
    x, l = np.array([r[0] for r in rows[:60]]), np.array([r[1] for r in rows[:60]])
    d = cluster._distances(x, x, "cosine_similarity")
    values = []
    for i in range(60):
        means = [d[i, l == k].sum() / ((l == k).sum() - (k == l[i])) for k in range(3)]
        a, b = means[l[i]], min(m for k, m in enumerate(means) if k != l[i])
        values.append((b - a) / max(a, b))
    assert abs(got - np.mean(values)) < 1e-9
    units = frame.select(cluster._unit(F.col("v")).alias("u")).collect()
    assert units[60]["u"] is None and np.allclose([r["u"] for r in units[:60]], cluster._units(x))


def test_sums_of_a_tile_by_label():
    rng = np.random.default_rng(5)
    for several in (3, 40):
        d, labels, weights = rng.random((50, 60)), np.sort(rng.integers(0, several, 60)), rng.integers(1, 5, 60).astype(float)
        d[4, 7] = np.inf
        there, sums = cluster._by_label(d, labels, weights)
        for i, k in enumerate(there):
            assert np.allclose(sums[:, i], (d * weights)[:, labels == k].sum(axis=1))
