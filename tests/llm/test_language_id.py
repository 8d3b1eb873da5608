import math
import random
import zlib

import numpy as np

from tidemark.llm import langid

WORDS = {"en": "the and of with that which have from", "de": "und der die nicht mit das eine werden", "fr": "le et les dans que pour une avec"}


def brute_bits(model, lang, text):
    """Code length from the trees, byte by byte."""
    data, bits = langid.normal_bytes(text), 0.0
    counts = model[lang]
    for at in range(3, len(data)):
        for order in range(3, -2, -1):
            if order < 0:
                bits += 8
                break
            seen = {b: n for (context, b), n in counts.items() if context == data[at - order:at]}
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if data[at] in seen:
                bits -= math.log2(seen[data[at]] / total)
                break
            bits -= math.log2(len(seen) / total)
    return bits


def corpus(n, seed):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(30)), lang) for i, lang in ((k, rng.choice(list(WORDS))) for k in range(n))]


def test_code_lengths_are_exact(spark):
    rows = corpus(12, 1)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.freeze(langid.train(frame))
    brute = {lang: {} for lang in model.langs}
    for _, text, lang in rows:
        data = langid.normal_bytes(text)
        for at in range(3, len(data)):
            for order in range(4):
                key = (data[at - order:at], data[at])
                brute[lang][key] = brute[lang].get(key, 0) + 1
    for text in ("the xylophone und 1999", "q", "avec la mer"):
        found = langid.runs(langid.normal_bytes(text), 4)
        rows_of = model.second[model.first[found >> np.uint32(8)].astype(np.int64) * 256 + (found & np.uint32(255))]
        for k, lang in enumerate(model.langs):
            exact = sum(model.code_length(k, int(r)) for r in found)
            assert math.isclose(exact, brute_bits(brute, lang, text), rel_tol=1e-9)
            assert all(math.isclose(model.codes[row][k], model.code_length(k, int(r)), rel_tol=1e-9) for row, r in zip(rows_of, found) if row)


def test_held_out_accuracy_and_edges(spark, edges):
    rows = [(i, t, lang, "s") for i, t, lang in corpus(400, 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = langid.identify(frame).toPandas().merge(frame.toPandas(), on="doc_id")
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    assert (got[got["held_out"]]["lang_pred"] == got[got["held_out"]]["lang"]).mean() > 0.98
    odd = langid.identify(edges).collect()
    assert len(odd) == edges.count()
    for r in odd:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (2, 3, 4):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "de", "fr")


def test_held_out_rows_teach_nothing(spark):
    rows = corpus(60, 3)
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    other = [(i, t, "xx" if i in held else lang) for i, t, lang in rows]
    a, b = (sorted(langid.identify(spark.createDataFrame(x, "doc_id long, text string, lang string")).collect()) for x in (rows, other))
    assert a == b


def test_bounded_model_still_predicts(spark):
    frame = spark.createDataFrame(corpus(80, 4), "doc_id long, text string, lang string")
    counts = langid.train(frame, max_nodes=50)
    assert all(len(part[1]) <= 50 for part in counts)
    assert langid.predict(frame, counts).where("lang_pred <> 'und'").count() == 80


def test_no_run_is_left_out(spark):
    # More than 100,000 distinct runs, most of one language; the other has few documents.
    rng = random.Random(6)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    rows = [(i, letters(2500), "hot") for i in range(100)]
    rows += [(200 + i, letters(rng.randint(5, 400)), "rare") for i in range(12)]
    rows += [(300 + i, letters(rng.randint(3, 9)), "rare" if i % 4 else "hot") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    taught = spark.createDataFrame([r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2], frame.schema)
    counts = langid.train(taught, max_nodes=10**9)
    assert len(counts[-1][1]) > 100_000
    want = {r["doc_id"]: r for r in langid.predict(frame.coalesce(1), counts).collect()}
    longest = langid.count_runs(taught).localCheckpoint()
    for got in (langid.identify(frame), langid.predict_whole(frame.coalesce(1), longest, cells=50_000)):
        got = {r["doc_id"]: r for r in got.collect()}
        assert got.keys() == want.keys()
        for doc, r in got.items():
            assert r["lang_pred"] == want[doc]["lang_pred"] and math.isclose(r["score"], want[doc]["score"], rel_tol=1e-9)


def test_no_training_rows(spark, nothing):
    assert langid.identify(nothing).count() == 0
    frame = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in langid.identify(frame).collect()] == [("und", 0.0)]
