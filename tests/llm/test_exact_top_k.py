import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bitsliced


def brute(rows, k, is_query):
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    asked = {}
    for i, v in whole:
        if is_query(i):
            asked[i] = min(asked.get(i, v), v)
    for i, v in asked.items():
        found = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i and len(w) == len(v))
        out += [(i, n, j, -s) for n, (s, j) in enumerate(found[:k], 1)]
    return sorted(out)


def test_matches_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]  # ties
    rows += [(7, rows[7][1]), (5, rows[3][1])]  # repeated ids
    rows += [(2000, [0.0] * 12), (2010, [1.0, None] + [0.0] * 10), (2020, [float("nan")] * 12), (2030, [float("inf")] * 12), (2040, None), (None, [1.0] * 12)]
    rows += [(3000, [1.0, 2.0]), (3010, [2.0, -1.0]), (4000, []), (4010, []), (5000, [3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit("x"), "v": F.lit(1), "block": F.lit(2)})
    for options in ({}, {"block_rows": 37, "chunk_queries": 5}, {"dropped": 0}, {"dropped": 20}):
        got = sorted(tuple(r) for r in bitsliced.top_k(frame, F.col("id") % 10 == 0, k=5, **options).collect())
        assert got == brute(rows, 5, lambda i: i % 10 == 0)


def test_ids_repeated_more_often_than_k(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(12)]) for i in range(300)]
    for i in (10, 20, 30, 40):
        # Own rows that score above all others.
        rows += [(i, [3 * x for x in rows[i][1]])] * 9
    # One id has most rows of the table.
    rows += [(50, [rng.gauss(0, 0.2) for _ in range(12)]) for _ in range(400)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for options in ({}, {"block_rows": 100, "chunk_queries": 5}, {"dropped": 0}):
        got = sorted(tuple(r) for r in bitsliced.top_k(frame, F.col("id") % 10 == 0, k=5, **options).collect())
        assert got == brute(rows, 5, lambda i: i % 10 == 0)


def test_one_id_is_dealt_over_the_blocks(spark):
    rows = bitsliced.stored(spark.range(2000).selectExpr("7L AS id", "array(id) AS v"))
    sizes = [len(r["ids"]) // 8 for r in bitsliced.build_index(rows, 10).collect()]
    assert len(sizes) == 10 and sum(sizes) == 2000 and max(sizes) < 300


def test_large_components(spark):
    """Products beyond a long's range are added exactly; what can't be returned stops the job."""
    rows = [(0, [2.0**40, -(2.0**40), 1.0]), (1, [2.0**42, 2.0**42, 5.0]), (2, [2.0**42 + 1, 2.0**42, -7.0]), (3, [-1.0, 0.5, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in bitsliced.top_k(frame, F.col("id") == 0, k=3).collect())
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    best = sorted((-sum(a * b for a, b in zip(whole[0], whole[i])), i) for i in (1, 2, 3))
    assert got == [(0, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    for rows in ([(0, [2.0**50]), (1, [2.0**50])], [(0, [1e20]), (1, [1.0])]):
        with pytest.raises(Exception, match="does not fit|too large"):
            bitsliced.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") == 0).collect()


def test_slices_add_up():
    rng = np.random.default_rng(3)
    values, weights = rng.integers(0, 200, (130, 9)), rng.integers(-300, 300, (4, 9))
    total, constant = bitsliced.add_slices(bitsliced._slices(values, 8), weights)
    for q in range(4):
        bits = [np.unpackbits(t[q].view(np.uint8), bitorder="little")[:130].astype(object) for t in total]
        assert (sum(b * (1 << c) for c, b in enumerate(bits)) - constant == values @ weights[q]).all()


def test_empty_table_and_single_row(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert bitsliced.top_k(empty, F.col("id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<float>")
    assert bitsliced.top_k(one, F.col("id") % 50 == 0).count() == 0
