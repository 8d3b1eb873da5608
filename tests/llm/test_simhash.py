import random
import re

import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import components


def brute_print(text, size=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    """Smallest member of each component; `linked` says which pairs are linked."""
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if label[a] < label[b] and linked(a, b):
                    label[b], changed = label[a], True
    return label


def test_prints_and_groups_on_edges(spark, edges):
    rows = simhash.simhash_groups(edges).collect()
    texts = {}
    for r in edges.collect():
        texts.setdefault(r["doc_id"], r["text"])
    assert len(rows) == edges.count()
    for r in rows:
        assert r["fp"] % 2**64 == brute_print(texts[r["id"]])
    got = {(r["id"], r["component"]) for r in rows}
    # 2, 3 and 4 have no words; the row without id has the text of 6.
    assert {(2, 2), (3, 2), (4, 2), (None, 6), (6, 6), (1, 1)} <= got


def test_links_match_brute_force(spark):
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for base in prints[:20]:
        for _ in range(6):
            flips = rng.sample(range(64), rng.randint(1, 6))
            prints.append(base ^ sum(1 << f for f in flips))
    prints = sorted(set(prints))
    signed = [(i, p - 2**64 if p >> 63 else p) for i, p in enumerate(prints)]
    rows = spark.createDataFrame(signed, "id long, fp long")
    for distance, count in ((4, 3), (4, 2), (3, 4), (0, 3)):
        pairs = {tuple(sorted((r["a"], r["b"]))) for r in simhash.near_pairs(rows, distance, count).collect()}
        want = {
            (a, b) for a in range(len(prints)) for b in range(a + 1, len(prints))
            if (prints[a] ^ prints[b]).bit_count() <= distance
        }
        assert pairs == want


def test_one_id_with_two_texts_links_them(spark):
    rows = [(1, "alpha beta gamma delta epsilon"), (2, "one two three four five six"), (2, "alpha beta gamma delta epsilon"), (3, "one two three four five six")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r["id"], r["component"]) for r in simhash.simhash_groups(docs).collect()} == {(1, 1), (2, 1), (3, 1)}


def test_components_of_paths_and_stars(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(50)]
    links += [(7, 7), (1, 0)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    both = {frozenset(x) for x in links}
    nodes = sorted({n for a, b in links if a != b for n in (a, b)})
    assert got == brute_components(nodes, lambda a, b: frozenset((a, b)) in both)


def test_empty_table(spark, nothing):
    assert simhash.simhash_groups(nothing).count() == 0
