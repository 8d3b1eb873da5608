"""Degenerate rows, many columns and labels, and rows returned to by small summaries."""

import math
import random

from pyspark.sql import functions as F

from tidemark.functions.distributions import f_tail_value
from tidemark.operators import cluster, decompose, hypothesis, ranking, scaling
from tidemark.operators.attach import attach


def score(frame):
    return frame.first()["score"]


def test_one_null_rule_for_any_number_of_columns(spark):
    rng = random.Random(1)
    rows = [tuple(None if rng.random() < 0.1 else rng.random() for _ in range(26)) for _ in range(30)]
    names = [f"c{i}" for i in range(26)]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    for width in (24, 25, 26):
        got = {(r["row_name"], r["column_name"]): r["covariance"] for r in decompose.covariance_table(frame, names[:width]).collect()}
        assert len(got) == width * width
        both = [(r[0], r[3]) for r in rows if r[0] is not None and r[3] is not None]
        mx, my = (sum(v) / len(both) for v in zip(*both))
        assert math.isclose(got["c0", "c3"], sum((a - mx) * (b - my) for a, b in both) / (len(both) - 1))


def test_manhattan_silhouette_with_many_labels_and_any_scale(spark):
    rng = random.Random(2)
    rows = [(k % 70, [rng.random() + k % 70, rng.random()]) for k in range(210)]

    def brute(factor):
        total, n = 0.0, 0
        for label, v in rows:
            near = {}
            for other, w in rows:
                near.setdefault(other, []).append(factor * sum(abs(a - b) for a, b in zip(v, w)))
            a = sum(near[label]) / (len(near[label]) - 1)
            b = min(sum(d) / len(d) for other, d in near.items() if other != label)
            total, n = total + (b - a) / max(a, b), n + 1
        return total / n

    want = brute(1.0)
    for factor in (1.0, 1e-12):
        frame = spark.createDataFrame([(label, [factor * x for x in v]) for label, v in rows], "label int, v array<double>")
        assert math.isclose(score(cluster.silhouette(frame, "v", "label", "manhattan")), want, rel_tol=1e-6)


def test_zero_vectors_and_singletons(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.1]), (1, [0.0, 1.0]), (1, [0.1, 1.0]), (1, [0.0, 0.0])], "label int, v array<double>")
    whole = frame.where("v[0] + v[1] > 0")
    assert score(cluster.silhouette(frame, "v", "label", "cosine_similarity")) == score(cluster.silhouette(whole, "v", "label", "cosine_similarity"))
    single = spark.createDataFrame([(k, [1.0, 0.3 * k]) for k in range(4)], "label int, v array<double>")
    assert score(cluster.dunn(single, "v", "label", "cosine_similarity")) == 0.0


def test_start_weighs_equal_rows(spark):
    rows = [([0.0, 0.0],)] * 997 + [([5.0, 1.0],), ([1.0, 5.0],), ([9.0, 9.0],)]
    frame = spark.createDataFrame(rows, "v array<double>")
    firsts = [cluster.spread_start(frame, "v", 1, seed, "manhattan")[0] for seed in range(12)]
    assert firsts.count([0.0, 0.0]) >= 11


def test_one_class_and_equal_quartiles(spark):
    one = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "c string, x double")
    assert hypothesis.anova_f_test(one, ["x"], "c").first()["f"] is None
    flat = spark.createDataFrame([(1.0,)] * 9 + [(5.0,)], "x double")
    assert {r["bin_index"] for r in scaling.create_bins(flat, "x", "freedman_diaconis").collect()} == {1, 2}


def test_f_tail_at_large_samples():
    for dof in (1e9, 1e12, 1e14):
        assert math.isclose(f_tail_value(1.0, 2.0, dof), math.exp(-1), rel_tol=1e-8)
    assert math.isclose(f_tail_value(1.0, 2.0, 10.0), 1.2 ** -5, rel_tol=1e-12)


def test_summaries_come_back_alike_broadcast_or_salted(spark):
    rows = spark.createDataFrame([(None if k % 5 == 0 else k % 5, k) for k in range(50)], "k int, x int")
    sums = rows.groupBy("k").agg(F.sum("x").alias("s"))
    a, b = (sorted(map(str, attach(rows, sums, ["k"], limit).collect())) for limit in (100, 2))
    assert a == b and len(a) == 50 and "s=None" not in "".join(a)


def test_split_is_a_filter_without_a_shuffle_on_strata(spark):
    frame = spark.range(1000).withColumn("g", F.col("id") % 3)
    split = ranking.lowest_by_hash(frame, ["g"], ["id"], 7, F.ceil(F.col("n") * 0.2))
    counts = {r["g"]: r["c"] for r in split.where("chosen").groupBy("g").agg(F.count("*").alias("c")).collect()}
    assert counts == {0: 67, 1: 67, 2: 67} and split.count() == 1000
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
