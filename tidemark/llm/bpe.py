"""BPE encoding and decoding through a table of distinct words.

1. Spark tasks split texts into words, the vocabulary's own pre-tokens. A block of documents of
   bounded size numbers its distinct words; a text becomes its words' numbers by position.
2. The blocks' word lists meet in buckets by word hash. A bucket holds the table of its distinct
   words and encodes each of them once, whatever the number of blocks and texts that bear it.
3. The ids go back to the blocks and are joined to the texts by position.
4. Decoding joins the pages of ids that each block needs with the table of id and piece, which the
   vocabulary bounds, and joins the pieces back by position likewise.

A block knows a word once, so a word that fills a third of the corpus is one row per block, and no
key is hot. What moves is each block's word list, its ids, and the compressed numbers.

The source must give the same rows in the same order when it is read again, as a table does; a
checksum over each block's words stops the job otherwise.

Defined results: a NULL or empty text has no ids and decodes to the empty text; a special token's
string inside a text becomes that token; ids may be NULL or repeat, each row keeps its own.
Texts of any length are encoded whole; an empty table gives no rows, and columns other than the id and
the text are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokenizer
from tidemark.llm.common import pack_numbers, unpack_numbers
from tidemark.session import stored

# Characters of a block: bounds what one task holds of texts' words.
BLOCK_CHARS = 32_000_000
# Documents and characters of one row of numbers.
CHUNK_DOCS, CHUNK_CHARS = 512, 1_000_000
# Bytes of text for each bucket of words: bounds the table of distinct words that a task holds.
BUCKET_BYTES = 64_000_000
# Code points on which the `regex` module's classes agree with the library's, and those on which the
# `re` module's agree too, where a letter is a word character but no digit or low line (tested one by one).
AGREED = r"[^\u0000-\u052F\u2000-\u2064\u20A0-\u20BF\u2100-\u214F]"
SIMPLE = r"[^\x00-\x1B\x20-\x7E\u00C0-\u024F]"


def splitter(path: str):
    """A function from a text to its words, the same as the library's pre-tokens.

    Texts of Latin letters are split by `re`, which is the fastest; those with characters outside
    the agreed ranges by the library itself.
    """
    import public_tokenizers
    import regex

    library, pattern = tokenizer.library(path), public_tokenizers.PATTERN
    find, other, further = regex.compile(pattern).findall, regex.compile(AGREED).search, re.compile(SIMPLE).search
    simple = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
    find_simple = find if r"\p" in simple else re.compile(simple).findall
    specials = [x.content for x in library.get_added_tokens_decoder().values()]
    cut = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")").split if specials else lambda t: [t]
    byte = tokenizer.byte_characters()

    def ordinary(text: str) -> list[str]:
        if not further(text):
            return find_simple(text)
        if not other(text):
            return find(text)
        return [bytes(byte[c] for c in w).decode() for w, _ in library.pre_tokenizer.pre_tokenize_str(text)]

    def split(text: str) -> list[str]:
        if not any(s in text for s in specials):
            return ordinary(text)
        return [w for part in cut(text) if part for w in ([part] if part in specials else ordinary(part))]

    return split


def _numbered(path: str, emit, block_chars: int):
    """A task over (id, text): numbers the words block by block in the order they come.

    `emit` gets the block, its distinct words as a binary array, and its chunks: keys, counts of
    words and their numbers by position.
    """

    def run(batches):
        split, part, serial = splitter(path), TaskContext.get().partitionId(), 0
        held, keys, counts, found, chars, fresh = [], [], [], [], 0, 0

        def close():
            held.append((keys.copy(), counts.copy(), pa.array(found, pa.string()).cast(pa.binary())))
            for x in (keys, counts, found):
                x.clear()

        def flush():
            numbered = pa.concat_arrays([w for *_, w in held]).dictionary_encode()
            ends = np.cumsum([len(w) for *_, w in held])
            chunks = [(k, c, n) for (k, c, _), n in zip(held, np.split(numbered.indices.to_numpy(), ends[:-1]))]
            yield from emit(part << 32 | serial, numbered.dictionary, chunks)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = split(text or "")
                keys.append(key)
                counts.append(len(own))
                found += own
                fresh += len(text or "")
                if len(keys) >= CHUNK_DOCS or fresh >= CHUNK_CHARS or chars + fresh >= block_chars:
                    close()
                    chars, fresh = chars + fresh, 0
                if chars >= block_chars:
                    yield from flush()
                    held, chars, serial = [], 0, serial + 1
        if keys:
            close()
        if held:
            yield from flush()

    return run


def _octets(array) -> tuple[np.ndarray, memoryview]:
    """The offsets and the data of a binary array."""
    width = np.int64 if pa.types.is_large_binary(array.type) else np.int32
    offsets = np.frombuffer(array.buffers()[1], dtype=width)[array.offset:array.offset + len(array) + 1]
    return offsets.astype(np.int64), memoryview(array.buffers()[2] or b"").cast("B")


def _checksum(words) -> int:
    offsets, data = _octets(words)
    return zlib.crc32(data[offsets[0]:offsets[-1]], zlib.crc32(np.diff(offsets).tobytes()))


def word_pages(docs: DataFrame, path: str, buckets: int, block_chars: int) -> DataFrame:
    """(block, bucket, checksum, numbers, sizes, words): each block's distinct words, once per bucket.

    A row holds all words of one block and bucket, compressed, with their sizes and numbers.
    """
    schema = pa.schema([
        ("block", pa.int64()), ("bucket", pa.int32()), ("checksum", pa.int64()), ("numbers", pa.binary()),
        ("sizes", pa.binary()), ("words", pa.binary()),
    ])

    def emit(block, words, _):
        import zstandard

        check = _checksum(words)
        share = pd.util.hash_array(np.array(words.to_pylist(), dtype=object), categorize=False) % np.uint64(buckets)
        # Within a bucket in order of their numbers, whose steps are small.
        order = np.argsort(share, kind="stable")
        offsets, data = _octets(words.take(pa.array(order)))
        share = share[order]
        begins = np.flatnonzero(np.concatenate([[True], share[1:] != share[:-1]])) if len(share) else []
        for i, j in zip(begins, [*begins[1:], len(share)]):
            yield pa.RecordBatch.from_pylist([{
                "block": block, "bucket": int(share[i]), "checksum": check,
                "numbers": pack_numbers(np.diff(order[i:j], prepend=0)), "sizes": pack_numbers(np.diff(offsets[i:j + 1])),
                "words": zstandard.compress(data[offsets[i]:offsets[j]], 3),
            }], schema)

    return docs.mapInArrow(
        _numbered(path, emit, block_chars),
        "block bigint, bucket int, checksum bigint, numbers binary, sizes binary, words binary",
    )


def text_numbers(docs: DataFrame, path: str, block_chars: int) -> DataFrame:
    """(block, checksum, keys, counts, numbers): texts as their words' numbers by position."""
    schema = pa.schema([
        ("block", pa.int64()), ("checksum", pa.int64()), ("keys", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int32())), ("numbers", pa.binary()),
    ])

    def emit(block, words, chunks):
        for place, (keys, counts, numbers) in enumerate(chunks):
            yield pa.RecordBatch.from_pylist([{
                "block": block, "checksum": _checksum(words) if place == 0 else None, "keys": keys, "counts": counts,
                "numbers": pack_numbers(numbers),
            }], schema)

    return docs.mapInArrow(
        _numbered(path, emit, block_chars),
        "block bigint, checksum bigint, keys array<string>, counts array<int>, numbers binary",
    )


def encoded_words(pages: DataFrame, path: str) -> DataFrame:
    """(block, checksum, numbers, counts, ids, used): the pages' words encoded.

    Pages arrive bucket by bucket. The bucket's table of distinct words fills as they come, and a
    word is encoded when it is first met; `used` has a bit for each page of the id-to-piece table.
    """
    schema = pa.schema([
        ("block", pa.int64()), ("checksum", pa.int64()), ("numbers", pa.binary()), ("counts", pa.binary()),
        ("ids", pa.binary()), ("used", pa.int64()),
    ])
    width = page_width(path)

    def encode(batches):
        import zstandard

        whole = tokenizer.whole_texts(path)

        class Known(dict):
            def __missing__(self, word):
                self[word] = found = np.array(whole(word.decode()), dtype="<u4").tobytes()
                return found

        bucket, known = None, Known()
        for batch in batches:
            for page in batch.to_pylist():
                if page["bucket"] != bucket:
                    bucket, known = page["bucket"], Known()
                data, ends = zstandard.decompress(page["words"]), np.cumsum(unpack_numbers(page["sizes"])).tolist()
                found = [known[data[i:j]] for i, j in zip([0, *ends], ends)]
                ids = np.frombuffer(b"".join(found), dtype="<u4")
                yield pa.RecordBatch.from_pylist([{
                    "block": page["block"], "checksum": page["checksum"], "numbers": page["numbers"],
                    "counts": pack_numbers(np.fromiter(map(len, found), dtype=np.uint32, count=len(found)) // 4),
                    "ids": pack_numbers(ids), "used": sum(1 << k for k in np.unique(ids // width).tolist()),
                }], schema)

    together = pages.repartition("bucket").sortWithinPartitions("bucket", "block")
    return together.mapInArrow(
        encode, "block bigint, checksum bigint, numbers binary, counts binary, ids binary, used bigint"
    )


def piece_table(spark, path: str) -> DataFrame:
    """(id, piece): the vocabulary; its size is that of the vocabulary file."""
    rows = sorted(tokenizer.pieces(path).items())
    frame = pa.table({"id": pa.array([i for i, _ in rows], pa.int32()), "piece": pa.array([p for _, p in rows], pa.binary())})
    return spark.createDataFrame(frame)


def page_width(path: str) -> int:
    """Ids of one of at most 63 pages of the id-to-piece table."""
    return -(-(max(tokenizer.pieces(path)) + 1) // 63)


def block_pieces(words: DataFrame, path: str) -> DataFrame:
    """(block, pieces): the pages of the id-to-piece table that hold ids of the block.

    The pages that a block needs are bits of one number, combined before anything is multiplied.
    """
    page = (F.col("id") / page_width(path)).cast("int").alias("page")
    table = piece_table(words.sparkSession, path).groupBy(page).agg(F.collect_list(F.struct("id", "piece")).alias("pieces"))
    needed = words.groupBy("block").agg(F.bit_or("used").alias("used"))
    bits = F.filter(F.sequence(F.lit(0), F.lit(62)), lambda k: F.getbit("used", k) == 1)
    return needed.select("block", F.explode(bits).alias("page")).join(F.broadcast(table), "page").select("block", "pieces")


def _by_word(pieces: list[bytes], ids: np.ndarray, ends: np.ndarray):
    """A binary array with a row per word: the pieces of its ids, one after another."""
    flat = pa.array(pieces, pa.large_binary()).take(pa.array(ids))
    offsets, _ = _octets(flat)
    bounds = np.ascontiguousarray(offsets[np.concatenate([[0], ends])])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(bounds), flat.buffers()[2] or pa.py_buffer(b"")])


def _assemble(digests: bool, schema: pa.Schema):
    """Join ids and pieces to the texts of one block by position."""

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        pages, piece, checks = [], {}, set()
        for row in right.to_pylist():
            if row["pieces"] is None:
                checks.add(row["checksum"])
                pages.append([unpack_numbers(row[c]) for c in ("numbers", "counts", "ids")])
            else:
                piece |= {x["id"]: x["piece"] for x in row["pieces"]}
        left = left.to_pylist()
        wrong = {x["checksum"] for x in left if x["checksum"] is not None} ^ checks
        if wrong and pages:
            raise ValueError("the source gave other texts when it was read again")
        # Ids of all words, first in the order of the pages, then in that of the words' numbers.
        none = np.empty(0, np.int64)
        places = np.concatenate([none, *(np.cumsum(n, dtype=np.int64) for n, _, _ in pages)])
        each = np.concatenate([none, *(c for _, c, _ in pages)]).astype(np.int64)
        ids = np.concatenate([none, *(i for *_, i in pages)]).astype(np.int64)
        order = np.argsort(places)
        sizes = each[order]
        ends = np.cumsum(sizes)
        ids = ids[np.arange(len(ids)) + np.repeat((np.cumsum(each) - each)[order] - (ends - sizes), sizes)]
        known = np.array(sorted(piece), dtype=np.int64)
        rows = np.searchsorted(known, ids)
        back = _by_word([piece[i] for i in known.tolist()], rows, ends)
        listed = _by_word([b"%d," % i for i in known.tolist()], rows, ends) if digests else None
        out = []
        for chunk in left:
            numbers = unpack_numbers(chunk["numbers"]).astype(np.int64)
            bounds = np.cumsum(np.concatenate([[0], chunk["counts"]]).astype(np.int64))
            tokens = np.concatenate([[0], np.cumsum(sizes[numbers])])[bounds]
            at, data = _octets(back.take(pa.array(numbers)))
            at = at[bounds].tolist()
            # Bytes that are no UTF-8 become the replacement character.
            decoded = [bytes(data[i:j]).decode("utf-8", "replace") for i, j in zip(at, at[1:])]
            if digests:
                at, data = _octets(listed.take(pa.array(numbers)))
                at = at[bounds].tolist()
                columns = [
                    np.diff(tokens), [hashlib.sha256(data[i:max(i, j - 1)]).hexdigest() for i, j in zip(at, at[1:])],
                    [hashlib.sha256(d.encode()).hexdigest() for d in decoded],
                ]
            else:
                own, begin = sizes[numbers], (ends - sizes)[numbers]
                flat = ids[np.arange(tokens[-1]) + np.repeat(begin - (np.cumsum(own) - own), own)]
                columns = [[flat[i:j] for i, j in zip(tokens, tokens[1:])], decoded]
            out.append(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip([chunk["keys"], *columns], schema)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return join


def encode_decode(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", path: str | None = None, digests: bool = False,
    buckets: int | None = None, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(id, ids, decoded) of every row, or with `digests` (id, n_tokens, ids_sha256, decoded_sha256).

    `buckets` divides the distinct words; by default one for each 64 MB of text, and at least four for
    each shuffle partition.
    """
    path = path or tokenizer.default_path()
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(F.col(f"`{id_column}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text"))
    if not buckets:
        size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    words = stored(encoded_words(word_pages(source, path, buckets, block_chars), path))
    nothing = F.lit(None)
    right = words.select("block", "checksum", "numbers", "counts", "ids").withColumn(
        "pieces", nothing.cast("array<struct<id:int,piece:binary>>")
    ).unionByName(block_pieces(words, path), allowMissingColumns=True)
    if digests:
        schema = pa.schema([("key", pa.string()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
        columns = "key string, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    else:
        schema = pa.schema([("key", pa.string()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
        columns = "key string, ids array<int>, decoded string"
    left = text_numbers(source, path, block_chars).groupBy("block")
    out = left.cogroup(right.groupBy("block")).applyInArrow(_assemble(digests, schema), columns)
    return out.select(F.col("key").cast(kind).alias(id_column), *out.columns[1:])


def decode(encoded: DataFrame, id_column: str, ids: str = "ids", path: str | None = None) -> DataFrame:
    """(id, decoded) of any table of ids: one row per position joins its piece.

    Unknown ids decode to nothing. The rows of one `id_column` value are one text; it must be unique.
    """
    path = path or tokenizer.default_path()
    table = piece_table(encoded.sparkSession, path)
    flat = encoded.select(F.col(id_column), F.posexplode_outer(ids).alias("place", "id"))
    joined = flat.join(F.broadcast(table), "id", "left")
    texts = joined.groupBy(id_column).agg(F.array_sort(F.collect_list(F.struct("place", "piece"))).alias("parts"))
    octets = F.aggregate(
        "parts", F.lit("").cast("binary"), lambda a, x: F.concat(a, F.coalesce(x["piece"], F.lit("").cast("binary")))
    )
    return texts.select(id_column, octets.cast("string").alias("decoded"))
