import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as hn

FIRST = hn.FIRST_DEPTH


def brute(rows, is_anchor, positives=5, k=5, low=80, high=100):
    whole = [
        (i, str(label), [math.floor(256 * float(x)) for x in v]) for i, v, label in rows
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    asked = {}
    for i, label, v in whole:
        if is_anchor(i):
            asked[i] = min(asked.get(i, (label, v)), (label, v))
    out = []
    for i, (label, v) in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in whole if j != i and len(w) == len(v))
        for minus, p, other in [x for x in scored if x[2] == label][:positives]:
            fit = [x for x in scored if x[2] != label and low * -minus <= 100 * -x[0] <= high * -minus]
            out += [(i, p, rank, x[1], -minus, -x[0]) for rank, x in enumerate(fit[:k], 1)]
    return sorted(out)


def frame_of(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return frame.withColumns({c: F.lit("clash") for c in ("id", "v", "block", "part", "parts", "scores", "chunk", "dims")})


def clustered(rng, count, dims=8, labels=4):
    centres = [[rng.gauss(0, 0.4) for _ in range(dims)] for _ in range(6)]
    return [(i, [c + rng.gauss(0, 0.15) for c in rng.choice(centres)], rng.randrange(labels)) for i in range(count)]


def test_matches_brute_force(spark):
    rng = random.Random(4)
    rows = clustered(rng, 400)
    rows += [(1000 + i, rows[10][1], i % 3) for i in range(30)]  # ties
    rows += [(20, rows[20][1], 1), (20, rows[33][1], 0), (41, rows[41][1], rows[41][2])]  # repeated ids
    rows += [(2000, [0.0] * 8, 1), (2010, [1.0, None] + [0.0] * 6, 1), (2020, [float("nan")] * 8, 0), (2030, None, 0), (2040, [1.0] * 8, None)]
    rows += [(None, [1.0] * 8, 1), (3000, [1.0, -2.0], 1), (3010, [2.0, 1.0], 1), (3011, [1.9, 1.1], 2), (4000, [], 1), (4001, [], 1), (4002, [], 2)]
    frame = frame_of(spark, rows)
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 500
    for options in ({}, {"block_rows": 37, "chunk_anchors": 5}):
        got = hn.hard_negatives(frame, F.col("id") % 10 == 0, F.col("label"), **options)
        assert sorted(tuple(r) for r in got.collect()) == want
    got = hn.hard_negatives(frame, F.col("id") % 10 == 0, F.col("label"), positives=2, k=3, low=50, high=90, block_rows=64)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda i: i % 10 == 0, 2, 3, 50, 90)


def test_one_label_with_most_rows_and_many_small_labels(spark):
    rng = random.Random(8)
    rows = [(i, v, 0 if i % 3 else 10 + i) for i, v, _ in clustered(rng, 600, 5)]
    frame = frame_of(spark, rows)
    got = hn.hard_negatives(frame, F.col("id") % 20 == 1, F.col("label"), block_rows=50)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda i: i % 20 == 1)


def test_components_beyond_doubles_are_exact(spark):
    big = float(2**35) + 1
    rows = [(0, [2.0**5, 1.0], 0), (1, [big, 0.0], 0), (2, [big - 1, 1.0], 1), (3, [big - 1, 0.0], 1), (4, [big, -1.0], 1), (5, [1.0, 1.0], 1)]
    got = hn.hard_negatives(frame_of(spark, rows), F.col("id") == 0, F.col("label"))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda i: i == 0)
    rows = [(0, [1e30], 0), (1, [1e30], 0), (2, [1e30], 1)]
    with pytest.raises(Exception, match="too large|Overflow|int64"):
        hn.hard_negatives(frame_of(spark, rows), F.col("id") == 0, F.col("label")).collect()


def test_reading_stops_before_the_end_of_the_lists():
    rng = np.random.default_rng(2)
    values = np.floor(256 * rng.normal(0, 0.1, (4000, 4)))
    values[:50] += 400
    order = np.argsort(-values.T, axis=1, kind="stable").astype(np.int32)
    block = hn.Block(np.arange(4000), np.zeros(4000, np.int32), ["a"], values, order)
    depths = []
    (scores, rows), = hn.threshold_search(block, values[0], np.arange(4000) != 0, [(None, None)], 5, depths)
    every = values @ values[0]
    every[0] = -np.inf
    best = np.lexsort((np.arange(4000), -every))[:5]
    assert rows.tolist() == best.tolist() and scores.tolist() == every[best].tolist()
    assert depths[0] <= 8 * FIRST


def test_empty_table_and_lonely_anchor(spark):
    assert hn.hard_negatives(frame_of(spark, []), F.col("id") % 10 == 0, F.col("label")).count() == 0
    assert hn.hard_negatives(frame_of(spark, [(0, [1.0], 1), (1, [1.0], 2)]), F.col("id") == 0, F.col("label")).count() == 0
