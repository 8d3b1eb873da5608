import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_simhash import brute_print

from tidemark.session import scratch_path


@pytest.fixture(scope="module")
def folder(spark):
    """Documents with junk, copies, near copies and extra columns; labels for half of them."""
    rng = random.Random(1)
    rows, bad = [], set()
    for k in range(60):
        words = [f"word{rng.randint(0, 9999)}" for _ in range(150)]
        if k % 6 == 5:
            words, bad = [w + "&&&" for w in words], bad | {k}
        rows.append((k, " ".join(words), "en", f"src{k % 4}", "mine"))
    rows += [(100 + k, rows[k][1], "en", "src0", "copy") for k in range(10)]
    rows += [(200 + k, rows[k][1] + " tail", "en", "src1", "near") for k in range(10)]
    rows += [(0, rows[0][1], "en", "src0", "mine"), (300, None, None, None, None), (301, "", "en", "src0", "x"), (None, rows[1][1], "en", "src0", "no id")]
    path = scratch_path(spark, "tables")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string")
    docs.withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{path}/documents.parquet")
    labels = [(k, int(k not in bad)) for k in range(0, 60)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return path, rows, bad


def test_stages_decide_as_brute_force(spark, folder):
    path, rows, bad = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, tables = docs.columns, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = scratch_path(spark, f"s{number}")
        stage(spark, docs, path).write.parquet(out)
        docs = spark.read.parquet(out)
        tables.append(docs)
    assert all(t.columns == columns for t in tables[:-1])
    first, second, third = ([r.asDict() for r in t.collect()] for t in tables[:3])
    copies_of_bad = bad | {100 + k for k in bad} | {200 + k for k in bad}
    assert {r["doc_id"] for r in first} >= {r[0] for r in rows if r[0] is not None and r[0] < 300} - copies_of_bad
    assert not {r["doc_id"] for r in first} & copies_of_bad
    assert {r["doc_id"] for r in second} == {r["doc_id"] for r in first if r["text"]}
    # One of each group: the smallest id among prints at four or fewer bits.
    by_id = {r["doc_id"]: brute_print(r["text"]) for r in second if r["doc_id"] is not None}
    near = lambda a, b: (by_id[a] ^ by_id[b]).bit_count() <= 4
    want = {a for a in by_id if not any(near(a, b) for b in by_id if b < a)}
    assert sorted(r["doc_id"] for r in third if r["doc_id"] is not None) == sorted(want)
    assert sum(r["doc_id"] is None for r in third) == 1
    assert {r["doc_id"] for r in tables[3].collect()} == want | {None}


def test_run_gives_the_last_stage(spark, folder):
    got = corpus_pipeline.run(spark, folder[0])
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 0


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder[0])
        assert docs.count() == 0
