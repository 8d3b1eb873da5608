import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import bilinear as lm

CLASSES, ENDINGS = 24, 8
SMALL = {"classes": CLASSES, "endings": ENDINGS, "width": 6}


def words(text):
    out, word = [], b""
    for c in (text or "").encode():
        if c in b" \t\n\v\f\r":
            out, word = out + [word] * bool(word), b""
        else:
            word += bytes([c + 32 if 65 <= c <= 90 else c])
    return out + [word] * bool(word)


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


class Plain:
    """Counts, classes and shares by the definition, without blocks."""

    def __init__(self, rows):
        self.count = Counter(w for i, t in rows if not held(i) for w in [*words(t), b"\n"])
        self.n, self.v = sum(self.count.values()), len(self.count)
        most = sorted((w for w in self.count if w != b"\n"), key=lambda w: (-self.count[w], w))[:CLASSES - ENDINGS - 1]
        self.own = {b"\n": 0} | {w: k for k, w in enumerate(most, 1)}
        self.size, self.members = Counter(), Counter()
        for w, c in self.count.items():
            self.size[self.of(w)] += c
            self.members[self.of(w)] += 1

    def of(self, w):
        return self.own.get(w, CLASSES - ENDINGS + zlib.crc32(w[-2:]) % ENDINGS)

    def share(self, w):
        c, k = self.count.get(w, 0), self.of(w)
        return 1.0 if k < CLASSES - ENDINGS else (c + 0.1) / (self.size[k] + 0.1 * (self.members[k] + 1))

    def next_class(self, p, far, near):
        scores = [(p.inner[near] @ p.near + p.inner[far] @ p.far) @ p.outer[k] + p.bias[k] for k in range(CLASSES)]
        return np.exp(scores) / np.exp(scores).sum()

    def score(self, p, text):
        far = near = 0
        total = 0.0
        for w in [*words(text), b"\n"]:
            total += math.log10(self.next_class(p, far, near)[self.of(w)] * self.share(w))
            far, near = near, self.of(w)
        return total


def corpus(seed=1):
    rng = random.Random(seed)
    kinds = [["the", "of", "and", "running", "king"], ["der", "die", "und", "Regen", "kam"]]
    rows = []
    for i in range(200):
        own = rng.choice(kinds)
        rows.append((i, " ".join(rng.choice(own) + rng.choice(["", "", "s", "x%d" % rng.randrange(30)]) for _ in range(rng.randint(0, 40)))))
    return rows + [(900 + i, None) for i in range(3)] + [(910, ""), (911, " \n\t "), (None, "a text without id"), (3, rows[3][1]), (920, "日本 ÀB\x0bc")]


def frame_of(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return frame.withColumns({c: F.lit("clash") for c in ("key", "block", "word", "n", "c", "class", "own", "held_out", "trains", "sizes")})


def test_matches_the_definition(spark):
    rows = corpus()
    plain, frame = Plain(rows), frame_of(spark, rows)
    for block_chars in (200, lm.BLOCK_CHARS):
        sequences, known = lm.prepare(frame, "doc_id", "text", ~lm.held_out(F.col("doc_id")), CLASSES, ENDINGS, block_chars)
        assert (known.total, known.distinct) == (plain.n, plain.v)
        p = lm.train_round(sequences, lm.first_parameters(known.frequency, 6), known.frequency, 0)
        got = lm.score_sequences(sequences, p, known.total).collect()
        assert len(got) == len(rows)
        texts = {(i, len(words(t)) + 1): t for i, t in rows}
        for r in got:
            i = None if r["key"] is None else int(r["key"])
            text = texts[i, r["n_tokens"]]
            own = [*words(text), b"\n"]
            base = sum(math.log10((plain.count.get(w, 0) + 0.1) / (plain.n + 0.1 * (plain.v + 1))) for w in own)
            assert r["n_known"] == sum(w in plain.count for w in own) and r["train_tokens"] == plain.n
            assert not r["trains"] == held(i)
            assert math.isclose(r["base_score"], base, rel_tol=1e-9)
            assert math.isclose(r["score"], plain.score(p, text), rel_tol=1e-4)


def test_probabilities_add_up_to_one(spark):
    rows = corpus(2)
    plain = Plain(rows)
    sequences, known = lm.prepare(frame_of(spark, rows), "doc_id", "text", ~lm.held_out(F.col("doc_id")), CLASSES, ENDINGS, 10_000)
    p = lm.train_round(sequences, lm.first_parameters(known.frequency, 6), known.frequency, 0)
    normalisers = lm.normaliser_table(spark, p)
    for far, near in ((0, 0), (3, 20), (23, 1)):
        chance = plain.next_class(p, far, near)
        scores = (p.inner[near] @ p.near + p.inner[far] @ p.far) @ p.outer.T + p.bias
        assert np.allclose(np.exp(scores - normalisers[far, near]), chance, atol=1e-5)
        total = sum(chance[plain.of(w)] * plain.share(w) for w in plain.count)
        # Each shared class has a place for unknown words.
        for k in range(CLASSES - ENDINGS, CLASSES):
            total += chance[k] * 0.1 / (plain.size[k] + 0.1 * (plain.members[k] + 1))
        # Classes without a word: the corpus has fewer words than own classes.
        total += sum(chance[k] for k in range(CLASSES - ENDINGS) if not plain.size[k])
        assert math.isclose(total, 1, abs_tol=1e-4)


def test_steps_follow_the_gradient_of_the_objective():
    rng = np.random.default_rng(5)
    frequency = rng.random(9)
    frequency /= frequency.sum()
    start = lm.first_parameters(frequency, 4)
    start = lm.Parameters(*(x.astype(np.float64) for x in vars(start).values()))
    near, far, after = rng.integers(0, 9, (3, 12))
    moves = {}
    trainer = lm.Trainer(start, frequency, (1,), noise=5)
    drawn = np.searchsorted(trainer.cumulated, np.random.default_rng((1,)).random(5) * trainer.cumulated[-1])

    def objective(p):
        context = p.inner[near] @ p.near + p.inner[far] @ p.far
        score = lambda k: context @ p.outer[k] + p.bias[k] - trainer.offset[k]
        true = sum(np.log1p(np.exp(-(context[t] @ p.outer[k] + p.bias[k] - trainer.offset[k]))) for t, k in enumerate(after))
        return (true + sum(np.log1p(np.exp(score(k))).sum() for k in drawn)) / len(after)

    trainer._move = lambda name, index, gradient: moves.update({name: (index, gradient)})
    trainer.step(near, far, after)
    for name, (index, gradient) in moves.items():
        full = np.zeros_like(getattr(start, name))
        full[index] = gradient
        for place in np.ndindex(full.shape):
            value, step = getattr(start, name), 1e-5
            kept = value[place]
            value[place] = kept + step
            above = objective(start)
            value[place] = kept - step
            below = objective(start)
            value[place] = kept
            assert math.isclose(full[place], (above - below) / (2 * step), rel_tol=1e-3, abs_tol=1e-5)


def test_held_out_texts_score_above_the_base(spark):
    rows = [(i, t) for seed in range(12) for i, t in enumerate(corpus(seed)[i][1] for i in range(200))]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    scored = lm.language_scores(frame_of(spark, rows).drop("held_out"), **SMALL).where("held_out").agg(
        F.sum("score"), F.sum("base_score"), F.sum("n_tokens")
    ).first()
    assert scored[0] / scored[2] > scored[1] / scored[2] + 0.1


def test_empty_tables_and_no_training_text(spark, nothing):
    assert lm.language_scores(nothing, **SMALL).count() == 0
    held_id = next(i for i in range(100) if held(i))
    r, = lm.language_scores(spark.createDataFrame([(held_id, "a b a")], "doc_id long, text string"), **SMALL).collect()
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (True, 4, 0, 0, 0.0)
    assert r["score"] <= 0


def test_long_text_and_edges(spark, edges):
    got = lm.language_scores(edges, **SMALL).collect()
    assert len(got) == edges.count() and max(r["n_tokens"] for r in got) == 30_001
    assert all(math.isfinite(r["score"]) for r in got)
