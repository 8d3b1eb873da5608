"""The public byte-level BPE vocabulary, read from its file on every worker."""

from __future__ import annotations

import functools
import json

# Characters that stand for the 256 byte values in the file: printable ones for themselves, the
# others, in order, for code points from 256 on.


def byte_characters() -> dict[str, int]:
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(path: str) -> dict[int, bytes]:
    """The bytes of every id, special tokens included."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    byte = byte_characters()
    out = {i: bytes(byte[c] for c in token) for token, i in content["model"]["vocab"].items()}
    out |= {x["id"]: x["content"].encode() for x in content["added_tokens"]}
    return out


@functools.cache
def library(path: str):
    """The tokenizers library's own object, without truncation and padding."""
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@functools.cache
def _core(path: str):
    """tiktoken's encoder for the file, or None where the file differs from what it can express.

    The vocabulary of the file numbers the 256 bytes first and then the merges in order, so ids are
    merge ranks; this is checked.
    """
    import tiktoken

    import public_tokenizers

    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    byte, vocab = byte_characters(), content["model"]["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
    ranked = all(vocab.get("".join(m)) == 256 + k for k, m in enumerate(merges)) and len(vocab) == 256 + len(merges)
    splitter = content["pre_tokenizer"] or {}
    plain = splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter["add_prefix_space"]
    special = {x["content"]: x["id"] for x in content["added_tokens"]}
    known = not any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in content["added_tokens"])
    if not (ranked and plain and known and content["normalizer"] is None):
        return None
    ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items()}
    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


@functools.cache
def whole_texts(path: str):
    """A function from a text to its ids, the same as the library gives, without offsets.

    Where tiktoken can't express the file, the library itself encodes, as it does a text that
    tiktoken's pattern matcher gives up on, such as one with a run of a million blanks.
    """
    core = _core(path)

    def by_library(text):
        return library(path).encode(text, add_special_tokens=False).ids

    def encode(text):
        try:
            return core.encode(text, allowed_special="all", disallowed_special=())
        except ValueError:
            return by_library(text)

    return encode if core else by_library


@functools.cache
def plain_texts(path: str):
    """As `whole_texts`, but special tokens' strings inside texts are plain text."""
    from tokenizers import Tokenizer

    core, other = _core(path), Tokenizer.from_file(path)
    other.no_truncation()
    other.no_padding()
    other.encode_special_tokens = True

    def by_library(text):
        return other.encode(text, add_special_tokens=False).ids

    def encode(text):
        try:
            return core.encode_ordinary(text)
        except ValueError:
            return by_library(text)

    return encode if core else by_library


def sentence_pieces(path: str):
    """The sentencepiece library's own object for a model file."""
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def sentence_piece_bytes(path: str) -> list[bytes]:
    """The bytes of every piece by id: U+2581 is a blank, <0xHH> a byte."""
    model = sentence_pieces(path)
    return [
        bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace("\u2581", " ").encode()
        for i, p in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))
    ]
