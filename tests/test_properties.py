"""Properties of fits, tests and files that have no SQL counterpart."""


import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import distributions as d
from tidemark.operators import cluster, decompose, hypothesis, models, scaling, spectral, splitting
from tidemark.sources import image_files, sinks, tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vectors(spark):
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    return df.withColumn("embedding", F.col("embedding").cast("array<double>")).persist()


@pytest.fixture(scope="module")
def matrix(vectors):
    return np.array([r[0] for r in vectors.orderBy("vec_id").select("embedding").collect()])


def test_tail_probabilities():
    assert d.chi2_tail_value(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert d.chi2_tail_value(18.307038053275146, 10) == pytest.approx(0.05, rel=1e-9)
    assert d.f_tail_value(4.102821015286661, 2, 10) == pytest.approx(0.05, rel=1e-6)
    assert d.f_tail_value(1.0, 5, 5) == pytest.approx(0.5, rel=1e-9)
    assert d.chi2_tail_value(0.0, 3) == 1.0


def test_significance_filter(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    every = hypothesis.chi2_test(orders, ["o_orderpriority", "o_custkey"], "o_orderstatus").collect()
    kept = hypothesis.chi2_test(orders, ["o_orderpriority", "o_custkey"], "o_orderstatus", 0.05, True).collect()
    assert {r["feature"] for r in kept} == {r["feature"] for r in every if r["p_value"] <= 0.05}


def test_quantile_normal_is_monotone_and_normal(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    rows = sorted(scaling.quantile_normal(events, "value", "z").select("value", "z").collect())
    z = np.array([r["z"] for r in rows])
    assert (np.diff(z) >= 0).all()
    inner = z[np.abs(z) < 3]
    assert abs(np.median(z)) < 0.05 and 0.9 < inner.std() < 1.1


def test_covariance_and_components(vectors, matrix):
    n, mean, cov = decompose.vector_moments(vectors, "embedding")
    assert n == len(matrix)
    assert cov == pytest.approx(np.cov(matrix.T), abs=1e-9)
    fitted = decompose.pca_fit(vectors, "embedding")
    assert fitted.components @ fitted.components.T == pytest.approx(np.eye(len(fitted)), abs=1e-9)
    rebuilt = fitted.components.T @ np.diag(fitted.variances) @ fitted.components
    assert rebuilt == pytest.approx(cov, abs=1e-9)
    singular = np.linalg.svd(matrix - matrix.mean(axis=0), compute_uv=False)
    assert fitted.singular_values == pytest.approx(singular, rel=1e-6)
    assert len(decompose.pca_fit(vectors, "embedding", var_threshold=0.5)) < len(fitted)
    assert len(decompose.pca_fit(vectors, "embedding", kaiser=True)) == 0


def test_pca_to_share(vectors, matrix):
    fitted = decompose.pca_to_share(vectors, "embedding", 0.9)
    share = fitted.variances.cumsum() / fitted.variances.sum()
    k = fitted.matrix.shape[1]
    assert share[k - 1] >= 0.9 > share[k - 2]
    scored = fitted.scores(vectors, "embedding").orderBy("vec_id").select("score_1").collect()
    expected = (matrix - matrix.mean(axis=0)) @ fitted.matrix[:, 0]
    assert [r[0] for r in scored] == pytest.approx(list(expected))


def test_many_columns_use_the_vector_form(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 30))
    names = [f"c{i}" for i in range(30)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], names)
    got = {(r[0], r[1]): r[2] for r in decompose.covariance_table(df, names).collect()}
    expected = np.cov(x.T)
    assert all(got[a, b] == pytest.approx(expected[i, j]) for i, a in enumerate(names) for j, b in enumerate(names))


def test_factors_explain_a_factor_model(spark):
    rng = np.random.default_rng(2)
    loadings = rng.normal(size=(8, 2)) * 2
    z = rng.normal(size=(4000, 2))
    x = z @ loadings.T + rng.normal(size=(4000, 8)) * 0.5
    df = spark.createDataFrame([(list(map(float, r)),) for r in x], "v array<double>")
    fitted = decompose.factor_fit(df, "v", 2)
    scored = np.array([list(r) for r in fitted.scores(df, "v").drop("v").collect()])
    # the factors are recovered up to a rotation
    fit = np.linalg.lstsq(scored, z, rcond=None)[0]
    assert ((scored @ fit - z) ** 2).mean() < 0.1
    assert decompose.factor_count(np.array([2.0, 1.5, 1.0, 0.5])) == 2


def test_discriminants_have_unit_variance_within_classes(vectors):
    fitted = decompose.lda_fit(vectors, "embedding", "label")
    rows = fitted.scores(vectors, "embedding").drop("embedding", "vec_id").collect()
    labels = np.array([r["label"] for r in rows])
    s = np.array([[v for k, v in r.asDict().items() if k != "label"] for r in rows])
    within = sum(
        (s[labels == c] - s[labels == c].mean(axis=0)).T @ (s[labels == c] - s[labels == c].mean(axis=0))
        for c in np.unique(labels)) / (len(s) - len(np.unique(labels)))
    assert within == pytest.approx(np.eye(s.shape[1]), abs=1e-6)
    assert s.shape[1] == len(np.unique(labels)) - 1
    spread = s.var(axis=0)
    assert (np.diff(spread) <= 1e-9).all()


@pytest.mark.parametrize("distance", ["euclidean", "manhattan", "cosine_similarity"])
@pytest.mark.parametrize("init", ["k-means++", "random"])
def test_kmeans_reaches_a_fixed_point(vectors, distance, init):
    centres = cluster.kmeans_fit(vectors, "embedding", 4, init, 50, distance, seed=8)
    labelled = cluster.assign_clusters(vectors, "embedding", centres, distance)
    _, again = cluster.centre_list(labelled, "embedding", "cluster")
    if distance != "euclidean" or init != "k-means++":
        assert np.array(again) == pytest.approx(np.array(centres), abs=1e-9)
    one = cluster.wcss(vectors.withColumn("c", F.lit(0)), "embedding", "c").first()[0]
    assert cluster.wcss(labelled, "embedding", "cluster").first()[0] < one


def test_kmeans_needs_a_known_distance(vectors):
    with pytest.raises(ValueError):
        cluster.kmeans_fit(vectors, "embedding", 2, distance="chebyshev")


def brute_silhouette(x, labels, distance):
    out = []
    for i in range(len(x)):
        own = (labels == labels[i]) & (np.arange(len(x)) != i)
        others = [labels == c for c in np.unique(labels) if c != labels[i]]
        if own.any() and others:
            a = distance(x[own], x[i]).mean()
            b = min(distance(x[o], x[i]).mean() for o in others)
            out.append(0 if a == b == 0 else (b - a) / max(a, b))
    return np.mean(out) if out else 0.0


@pytest.mark.parametrize("distance", ["euclidean", "manhattan", "cosine_similarity"])
def test_kmeans_runs_until_no_row_moves(vectors, distance):
    centres = cluster.kmeans_fit(vectors, "embedding", 10, distance=distance, seed=3)
    labelled = cluster.assign_clusters(vectors, "embedding", centres, distance, "near")
    means = {r["near"]: r["centre"] for r in cluster.update_centres(labelled, "embedding", "near").collect()}
    moved = [means.get(i, c) for i, c in enumerate(centres)]
    again = cluster.assign_clusters(labelled, "embedding", moved, distance, "again")
    assert again.where("near <> again").count() == 0
    with pytest.warns(RuntimeWarning, match="not converged"):
        cluster.kmeans_fit(vectors, "embedding", 10, distance=distance, seed=3, max_iter=1)


def test_silhouette_with_copies_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(cluster, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(150, 3)), 1)
    x[:50] = x[0]
    labels = rng.integers(0, 4, size=150)
    labels[-1] = 9
    df = spark.createDataFrame([(list(map(float, r)), int(c)) for r, c in zip(x, labels)], "v array<double>, l int")
    forms = {
        "euclidean": lambda a, b: np.sqrt(((a - b) ** 2).sum(axis=1)),
        "manhattan": lambda a, b: np.abs(a - b).sum(axis=1),
        "cosine_dissimilarity": lambda a, b: 1 - (a @ b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b)),
    }
    for name, form in forms.items():
        got = cluster.silhouette(df, "v", "l", name).first()[0]
        assert got == pytest.approx(brute_silhouette(x, labels, form), abs=1e-6)
    d2 = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    same = labels[:, None] == labels[None]
    assert cluster.dunn(df, "v", "l").first()[0] == pytest.approx(d2[~same].min() / d2[same].max())


def test_elbow_and_scores(vectors):
    table = cluster.elbow_test(vectors, "embedding", ks=(2, 3), scores=("inertia",), seed=1, max_iter=5).collect()
    assert [(r["n_clusters"], r["distance"]) for r in table] == [(2, "euclidean"), (3, "euclidean")]
    assert cluster.score(vectors, "embedding", "label").first()[0] < 0


def test_spectrum_keeps_the_energy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=40)
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(x)], "k string, i int, v double")
    whole = spectral.periodogram(df, "v", ["k"], ["i"], window="boxcar", return_onesided=False).collect()
    assert sum(r["power"] for r in whole) == pytest.approx((x ** 2).sum())
    half = spectral.periodogram(df, "v", ["k"], ["i"], window="boxcar").collect()
    assert sum(r["power"] for r in half) == pytest.approx((x ** 2).sum())
    padded = spectral.fft_spectrum(df, "v", ["k"], ["i"], nfft=64).orderBy("bin").collect()
    assert [r["magnitude"] for r in padded] == pytest.approx(list(np.abs(np.fft.fft(x, 64))[:32] * 2 / 64))
    cut = spectral.fft_spectrum(df, "v", ["k"], ["i"], nfft=15, norm="forward").orderBy("bin").collect()
    assert [r["magnitude"] for r in cut] == pytest.approx(list(np.abs(np.fft.fft(x, 15))[:8] / 15))
    line = df.withColumn("v", F.col("i") * 3.0 + 2)
    flat = spectral.periodogram(line, "v", ["k"], ["i"], detrend="linear").collect()
    assert max(r["power"] for r in flat) < 1e-18


def test_series_without_key(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=12)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, v double")
    power = spectral.periodogram(df, "v", [], ["i"], window="boxcar").collect()
    assert sum(r["power"] for r in power) == pytest.approx((x ** 2).sum())
    plan = scaling.minmax_by_group(df, [], "v", "s")
    assert max(r["s"] for r in plan.collect()) == 1.0
    assert "NestedLoop" not in plan._jdf.queryExecution().toString()


def test_models(vectors):
    rows = vectors.withColumn("y", (F.col("label") < 5).cast("int"))
    model = models.linear_classifier(rows, "embedding", "y")
    table = models.evaluate(model, {"Train": rows, "Test": rows}, "embedding", "y").collect()
    assert [r["split"] for r in table] == ["Train", "Test"] and table[0]["accuracy"] > 0.5
    loss = [r["loss"] for r in models.loss_history(model, rows).orderBy("epoch").collect()]
    assert loss[-1] <= loss[0]
    scored = models.batch_predict(model, rows, "embedding", "y", threshold=0.3)
    assert scored.where((F.col("probability_1") >= 0.3).cast("int") != F.col("prediction")).count() == 0


def test_image_catalog(spark, tmp_path):
    for folder, names in (("imagesTr", ["BRATS_001.nii.gz", "BRATS_002.nii.gz", "._BRATS_003.nii.gz", "BRATS_004.txt"]),
                          ("labelsTr", ["BRATS_001.nii.gz"]), ("imagesTs", ["BRATS_009.nii.gz"])):
        (tmp_path / folder).mkdir()
        for name in names:
            (tmp_path / folder / name).write_bytes(b"12345")
    rows = {r["id"]: r for r in image_files.task_catalog(spark, str(tmp_path)).collect()}
    assert set(rows) == {"001", "002"} and rows["001"]["length"] == 5
    assert rows["001"]["label_path"].endswith("labelsTr/BRATS_001.nii.gz") and rows["002"]["label_path"] is None
    assert [r["label_path"] for r in image_files.task_catalog(spark, str(tmp_path), "imagesTs/").collect()] == [None]
    one = image_files.task_catalog(spark, str(tmp_path), sample_size=1, seed=3)
    assert one.collect() == one.collect() and one.count() == 1


def test_typed_csv(spark, tmp_path):
    path = tmp_path / "users.csv"
    path.write_text("id_user_anon,country,words_in_user_profile\na,NL,3\nb,,\n")
    rows = tables.read_csv(spark, str(path), tables.USERS).collect()
    assert [tuple(r) for r in rows] == [("a", "NL", 3.0), ("b", None, None)]
    path.write_text("id_user_anon,country,words_in_user_profile\na,NL,many\n")
    with pytest.raises(Exception):
        tables.read_csv(spark, str(path), tables.USERS).collect()


def test_split_folders(spark, tmp_path):
    df = spark.range(20)
    sinks.write_split(splitting.train_test_split(df, ["id"], train_size=0.75), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert {r["split"]: r["count"] for r in back.groupBy("split").count().collect()} == {"train": 15, "test": 5}


def test_sample_per_label(spark):
    df = spark.range(100).withColumn("l", F.col("id") % 3)
    out = splitting.sample_per_label(df, "l", ["id"], 4, seed=2)
    assert {r["count"] for r in out.groupBy("l").count().collect()} == {4}
    assert out.select("id").distinct().count() == 12


def test_scalers_invert(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 6.0), (2, 5.0)], "k int, v double")
    forward = scaling.minmax_by_group(df, ["k"], "v", "s")
    assert sorted(r["s"] for r in forward.collect()) == [0.0, 0.0, 1.0]
    assert all(r["v"] == r["back"] for r in scaling.minmax_inverse(forward, "s", "back").collect())


def test_order_keys_follow_the_bits_of_doubles(spark):
    import random
    import struct

    from tidemark.operators.quantiles import with_order_key

    rng = random.Random(3)
    bits = [rng.getrandbits(64) for _ in range(3000)] + [0, 1, 2, (1 << 52) - 1, 1 << 52, (1 << 52) + 1, 0x7FEFFFFFFFFFFFFF, 0x7FF0000000000000]
    bits += [e << 52 | m for e in range(0, 2047, 7) for m in (0, 1, (1 << 52) - 1)]
    values = [struct.unpack("<d", struct.pack("<Q", b))[0] for b in bits]
    values += [-v for v in values] + [0.1, 1 / 3, -0.0, 1e300]
    values = [v for v in values if v == v]
    rows = with_order_key(spark.createDataFrame([(v,) for v in values], "v double"), "v", "k").collect()
    for r in rows:
        size = struct.unpack("<q", struct.pack("<d", abs(r["v"])))[0]
        assert r["k"] == (-size if r["v"] < 0 else size), r["v"]
