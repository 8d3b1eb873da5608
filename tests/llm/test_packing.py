import random
import zlib

import numpy as np

from tidemark.llm import packing, tokenizer


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_and_places_on_edges(spark, edges):
    rows = packing.pack(edges, capacity=64).collect()
    check(rows, 64)
    encode = tokenizer.whole_texts(tokenizer.default_path())
    want = []
    for r in edges.collect():
        ids = [*encode(r["text"] or ""), 0]
        first = (len(ids) - 1) % 64 + 1
        for piece, start in enumerate([0, *range(first, len(ids), 64)]):
            own = ids[start:first if not piece else start + 64]
            want.append((r["doc_id"], piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_very_long_runs_of_blanks(spark):
    path = tokenizer.default_path()
    texts = ["a" + blank * 1_200_000 + "b<|endoftext|> c" for blank in (" ", "\n", "\t ")]
    for text in texts:
        assert tokenizer.whole_texts(path)(text) == tokenizer.library(path).encode(text, add_special_tokens=False).ids
    docs = spark.createDataFrame([(1, texts[0]), (2, texts[1]), (3, "short")], "doc_id long, text string")
    rows = packing.pack(docs, capacity=2048).collect()
    check(rows, 2048)
    assert {r["doc_id"] for r in rows} == {1, 2, 3}


def test_reaches_the_lower_bound_over_many_groups(spark):
    rng = random.Random(2)
    lengths = [min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(3000)]
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long")
    placed = packing.place(items, group_pieces=300).join(items, "item").collect()
    assert sorted(r["item"] for r in placed) == list(range(3000))
    assert check(placed, 2048) <= 1.005 * sum(lengths) / 2048 + 1


def test_evolution_beats_best_fit_where_it_is_not_optimal():
    # Triplets that fill a sequence exactly; best fit decreasing needs more.
    rng, capacity, lengths = random.Random(1), 1000, []
    for _ in range(20):
        a = rng.randint(380, 490)
        b = rng.randint(255, 350)
        lengths += [a, b, capacity - a - b]
    greedy = packing.Packing(lengths, capacity)
    greedy.best_fit(list(range(len(lengths))))
    found = packing.evolve(lengths, capacity, [], "seed", generations=300, population=20)
    assert sorted(p for m in found.bins for p in m) == list(range(len(lengths)))
    assert all(sum(lengths[p] for p in m) <= capacity for m in found.bins)
    assert len(found.bins) <= len(greedy.bins)
    assert [m for m in found.bins] == packing.evolve(lengths, capacity, [], "seed", generations=300, population=20).bins


def test_crossover_keeps_every_piece_once():
    rng, lengths = random.Random(4), [random.Random(k).randint(1, 99) for k in range(200)]
    people = []
    for seed in range(2):
        order = list(range(200))
        random.Random(seed).shuffle(order)
        person = packing.Packing(lengths, 100)
        for p in order:
            person.best_fit([p])
        people.append(person)
    for _ in range(20):
        child = packing.crossover(*people, rng)
        assert sorted(p for m in child.bins for p in m) == list(range(200))
        assert child.fill == [sum(lengths[p] for p in m) for m in child.bins]
        assert max(child.fill) <= 100


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(k, "word " * k) for k in range(1, 40)], "doc_id long, text string")
    pieces = packing.cut_pieces(docs, capacity=32, with_ids=True)
    got = packing.sequences(pieces, packing.pack(docs, capacity=32)).collect()
    assert sum(len(r["ids"]) for r in got) == pieces.agg({"length": "sum"}).first()[0]
    assert max(len(r["ids"]) for r in got) <= 32


def test_empty_table(spark, nothing):
    assert packing.pack(nothing).count() == 0


def test_production_settings_beat_best_fit():
    """Lengths at which best fit is far from the bound: sequences of exactly three pieces, and a range."""
    rng = random.Random(1)
    triplets = []
    for _ in range(1333):
        a = rng.randint(520, 1000)
        b = rng.randint(300, 2048 - a - 300)
        triplets += [a, b, 2048 - a - b]
    for lengths, most in ((triplets, 1370), ([rng.randint(500, 1100) for _ in range(4000)], None)):
        plain = packing.Packing(lengths, 2048)
        plain.best_fit(list(range(len(lengths))))
        first = [packing.evolve(lengths, 2048, [], f"0-{island}-0") for island in range(packing.ISLANDS)]
        last = [packing.evolve(lengths, 2048, [first[k].bins, first[k - 1].bins], f"0-{k}-1") for k in range(packing.ISLANDS)]
        best = min(last, key=packing.Packing.score)
        assert sorted(p for members in best.bins for p in members) == list(range(len(lengths)))
        assert all(sum(lengths[p] for p in members) == filled <= 2048 for members, filled in zip(best.bins, best.fill))
        assert len(best.bins) < len(plain.bins) and (most is None or len(best.bins) <= most)
