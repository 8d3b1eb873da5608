import functools
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemark.llm import alignment, tokenizer

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@functools.cache
def both():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def token_bytes(text):
    """Ids and bytes of both sides, read from the libraries' own names of the tokens."""
    a, b = both()
    left = a.encode(" " + text, add_special_tokens=False)
    byte = tokenizer.byte_characters()
    right = b.encode(text)
    spell = lambda p: bytes([int(p[3:5], 16)]) if len(p) == 6 and p[:3] == "<0x" and p[-1] == ">" else p.replace("▁", " ").encode()
    return list(zip(left.ids, (bytes(byte[c] for c in t) for t in left.tokens))), [(i, spell(b.id_to_piece(i))) for i in right]


def brute(rows):
    """Every column by comparing all tokens of a text with all."""
    out, links = [], []
    for key, text in rows:
        a, b = token_bytes(text) if text else ([], [])
        whole = (" " + text).encode() if text else b""
        if not (b"".join(x for _, x in a) == whole == b"".join(x for _, x in b)):
            a, b = [], []
        spans = []
        for side in (a, b):
            at, found = 0, []
            for i, octets in side:
                found.append((i, at, at + len(octets)))
                at += len(octets)
            spans.append(found)
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, before = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for i, _, e in side if before < e <= end) for side in spans))
            before = end
        mine = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        links.append(mine)
        out.append((key, len(a), len(b), len(groups), len(mine), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    count = Counter(p for mine in links for p in mine)
    most = {}
    for (_, j), n in count.items():
        most[j] = max(most.get(j, 0), n)
    return [
        (*row[:5], sum(count[p] == most[p[1]] for p in mine), sum(count[p] for p in mine), row[5]) for row, mine in zip(out, links)
    ]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
order = lambda x: (x[0] is None, x[0] or 0, x[1])


def test_matches_brute_force(spark, edges):
    rng = random.Random(3)
    alphabet = ["the ", "running", " über", "日本", "\n", "  ", "x", "1234", "'ll", "🙂", "▁", "<s>", "é", "\x00", "<0x41>", "<|endoftext|>"]
    rows = [(i, "".join(rng.choices(alphabet, k=rng.randint(1, 40)))) for i in range(120)]
    rows += [(200 + i, "the same words in a hot text, again and again") for i in range(60)]
    rows += [(r["doc_id"], r["text"]) for r in edges.select("doc_id", F.substring("text", 1, 300).alias("text")).collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("key", "block", "pair", "n", "best", "id")}
    )
    want = sorted(brute(rows), key=order)
    assert sum(w[1] == 0 for w in want) > 3 and sum(w[1] > w[2] for w in want) > 3
    for options in ({}, {"block_chars": 400}):
        got = alignment.alignment_counts(frame.repartition(3), **options).select(*COLUMNS).collect()
        assert sorted((tuple(r) for r in got), key=order) == want


def test_whole_long_text(spark, edges):
    got = {r["doc_id"]: r for r in alignment.alignment_counts(edges.where("doc_id = 5")).collect()}
    a, b = token_bytes("Wort " * 30_000)
    assert (got[5]["n_a"], got[5]["n_b"]) == (len(a), len(b)) and got[5]["n_links"] >= max(len(a), len(b))


def test_groups_and_links_cover_every_token(spark, edges):
    for r in alignment.align(edges.where("doc_id <> 5 OR doc_id IS NULL")).collect():
        assert [g["a_end"] for g in r["groups"][-1:]] == [len(r["a_ids"])] * bool(r["a_ids"])
        assert {x["a"] for x in r["links"]} == set(range(len(r["a_ids"])))
        assert {x["b"] for x in r["links"]} == set(range(len(r["b_ids"])))


def test_empty_table(spark, nothing):
    assert alignment.alignment_counts(nothing).count() == 0
    assert alignment.align(nothing).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 400), min_size=1), st.lists(st.integers(0, 10_000), min_size=1, max_size=30))
def test_gallop_is_a_rank_from_any_start(ends, draws):
    ends = np.array(sorted(ends))
    wanted = np.array([d % ends[-1] + 1 for d in draws])
    start = np.array([d % len(ends) for d in reversed(draws)])
    assert (alignment.gallop(ends, wanted, start) == np.searchsorted(ends, wanted)).all()
