import hashlib

import pytest

from tidemark.llm import bpe, tokenizer

PATH = tokenizer.default_path()


def test_agrees_with_the_library_on_edges(spark, edges):
    library = tokenizer.library(PATH)
    rows = bpe.encode_decode(edges, buckets=5, block_chars=60).collect()
    want = []
    for r in edges.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], ids, library.decode(ids, skip_special_tokens=False)))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted([(r["doc_id"], r["ids"], r["decoded"]) for r in rows], key=key) == sorted(want, key=key)


def test_digests(spark, edges):
    plain = {(r["doc_id"], len(r["ids"])): r for r in bpe.encode_decode(edges).collect()}
    for r in bpe.encode_decode(edges, digests=True).collect():
        same = plain[r["doc_id"], r["n_tokens"]]
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, same["ids"])).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(same["decoded"].encode()).hexdigest()


def test_decode_alone(spark):
    rows = spark.createDataFrame([(1, [40, 716, 50256]), (2, []), (3, None), (4, [447])], "doc_id long, ids array<int>")
    library = tokenizer.library(PATH)
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(rows, "doc_id").where("doc_id < 4").collect()}
    assert got == {1: library.decode([40, 716, 50256], skip_special_tokens=False), 2: "", 3: ""}


def test_empty_table(spark, nothing):
    assert bpe.encode_decode(nothing).count() == 0


@pytest.mark.parametrize("ranges", [[(0, 0x530), (0x2000, 0x2065), (0x20A0, 0x20C0), (0x2100, 0x2150)]])
def test_split_agrees_on_every_agreed_code_point(ranges):
    import regex

    import public_tokenizers

    library, byte = tokenizer.library(PATH), tokenizer.byte_characters()
    find = regex.compile(public_tokenizers.PATTERN).findall
    other = regex.compile(bpe.AGREED)
    for first, end in ranges:
        for point in range(first, end):
            c = chr(point)
            assert not other.search(c)
            text = f"a{c}b {c}!{c}1{c} "
            split = [bytes(byte[x] for x in w).decode() for w, _ in library.pre_tokenizer.pre_tokenize_str(text)]
            assert split == find(text), hex(point)


def test_whole_text_ids_are_the_library_s():
    library, encode = tokenizer.library(PATH), tokenizer.whole_texts(PATH)
    for point in [*range(0x3000), *range(0x3000, 0x30000, 97)]:
        if not 0xD800 <= point < 0xE000:
            text = f"a{chr(point)}b {chr(point)}!{chr(point)}1 <|endoftext|>{chr(point)}\n"
            assert encode(text) == library.encode(text, add_special_tokens=False).ids, hex(point)


def test_split_of_latin_texts_agrees_on_every_code_point():
    import re

    library, byte, split = tokenizer.library(PATH), tokenizer.byte_characters(), bpe.splitter(PATH)
    further, seen = re.compile(bpe.SIMPLE).search, 0
    for point in range(0x250):
        c = chr(point)
        text = f"a{c}b {c}!{c}1{c}_{c}{c} {c}  {c}'s \n{c}"
        seen += not further(text)
        assert split(text) == [bytes(byte[x] for x in w).decode() for w, _ in library.pre_tokenizer.pre_tokenize_str(text)], hex(point)
    assert seen > 500
