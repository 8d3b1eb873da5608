import math
import random

from pyspark.sql import functions as F

from tidemark.llm import quality_classifier as qc


def corpus(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        good = rng.random() < (0.9 if k % 3 else 0.4)
        words = [f"word{rng.randint(0, 500)}" for _ in range(60)]
        if not good:
            words = [w + "&&&" for w in words]
        out.append((k, " ".join(words), f"host{k % 3}", ("a", None)[k % 2], int(good)))
    return out


def judge(spark, rows, labels, **options):
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, source string, lang string")
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    return qc.classify(docs.withColumns({c: F.lit("clash") for c in ("good", "label", "n", "id")}), frame, F.col("source"), F.col("lang"), **options)


def test_accuracy_and_posteriors_match_brute_force(spark):
    rows = corpus(300, 1)
    labels = [(r[0], r[4]) for r in rows if r[0] % 2]
    got = judge(spark, rows, labels).collect()
    truth = {r[0]: r[4] for r in rows}
    assert len(got) == 300 and all(r["accepted"] == bool(truth[r["doc_id"]]) for r in got)
    # The hierarchy again, from the evidence.
    known = dict(labels)
    share = sum(known.values()) / len(known)
    prior = math.log(share / (1 - share))
    good = {r["doc_id"]: known.get(r["doc_id"], 1 / (1 + math.exp(-(r["evidence"] + prior)))) for r in got}
    mean = sum(good.values()) / len(good)
    hosts, paths = {}, {}
    for r in got:
        for table, key in ((hosts, r["host"]), (paths, (r["host"], r["path"]))):
            n, g = table.get(key, (0, 0.0))
            table[key] = (n + 1, g + good[r["doc_id"]])

    def strength(groups, centre):
        v = sum(n * ((g / n - centre(k)) ** 2 - g / n * (1 - g / n) / n) for k, (n, g) in groups.items()) / sum(n for n, _ in groups.values())
        return qc.MOST if v <= 0 else min(qc.MOST, max(qc.LEAST, mean * (1 - mean) / v - 1))

    host_strength = strength(hosts, lambda k: mean)
    path_strength = strength(paths, lambda k: hosts[k[0]][1] / hosts[k[0]][0])
    for r in got:
        own = good[r["doc_id"]]
        n, g = hosts[r["host"]]
        host = (g - own + host_strength * mean) / (n - 1 + host_strength)
        n, g = paths[r["host"], r["path"]]
        path = (g - own + path_strength * host) / (n - 1 + path_strength)
        assert math.isclose(r["host_prior"], host, rel_tol=1e-6) and math.isclose(r["path_prior"], path, rel_tol=1e-6)
        assert math.isclose(r["quality"], 1 / (1 + math.exp(-(r["evidence"] + math.log(path / (1 - path))))), rel_tol=1e-5)


def test_site_decides_between_equal_texts(spark):
    rng = random.Random(2)
    rows = [(k, f"same text {rng.randint(0, 9)}", "bad" if k % 2 else "fine", "p", 1 - k % 2) for k in range(200)]
    got = judge(spark, rows, [(r[0], r[4]) for r in rows if r[0] < 150]).where("doc_id >= 150").collect()
    assert all(r["accepted"] == (r["host"] == "fine") for r in got)


def test_sample_bound_and_label_rules(spark):
    rows = corpus(120, 3)
    labels = [(r[0], r[4]) for r in rows] + [(0, 0), (0, 1), (1, None), (None, 1)]
    assert judge(spark, rows, labels, max_train_rows=40).count() == 120


def test_edges_without_labels(spark, edges, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = qc.classify(edges, labels, F.col("source"), F.col("lang")).collect()
    assert len(got) == edges.count() and all(r["accepted"] for r in got)
    assert qc.classify(nothing, labels, F.col("source"), F.col("lang")).count() == 0


def test_edges_with_labels(spark, edges):
    labels = spark.createDataFrame([(1, 1), (3, 0), (5, 0), (6, 1)], "doc_id long, quality int")
    got = qc.classify(edges, labels, F.col("source"), F.col("lang")).collect()
    assert len(got) == edges.count() and all(0 <= r["quality"] <= 1 for r in got)
