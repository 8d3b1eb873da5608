"""Alignment of two tokenizers' tokens by their common byte offsets.

A text is encoded by a byte-level BPE (A) and a sentencepiece model (B) over the same bytes. Each
side's token ends are an increasing list of byte offsets. The shorter list drives an intersection
with the longer: each of its ends starts at the place that its rank suggests, gallops from there in
doubling steps until it is bracketed, and ends in a binary search; all ends of a batch of texts take
these steps together. Ends on both lists cut the tokens into groups, and the difference of
neighbouring ranks is the range of the other side's tokens that a token overlaps: its links.

How often two ids are linked is counted over the whole corpus. Tasks take documents in blocks of
bounded size and write, once, each block's distinct id pairs with their counts, and each document's
links as numbers into that list. Spark sums the counts by pair and takes each B id's highest; a
block then gets back the totals of the pairs it named, and looks its documents' links up by number.
A pair is one row per block, however frequent, so no key is hot, and nothing is broadcast but the
highest counts, one row per id of the B vocabulary.

Defined results: a NULL or empty text, or one whose tokens don't spell it byte by byte, has no
tokens, links or groups; a special token's string is plain text. Texts of any length are taken
whole. Equal counts of a B id are all its highest. Ids may be NULL or repeat, each row keeps its own;
only the two named columns are read, whatever others are called; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokenizer
from tidemark.llm.common import pack_numbers, unpack_numbers
from tidemark.session import scratch_path, stored

# Characters of a block, and of the texts that are aligned together.
BLOCK_CHARS = 32_000_000
BATCH_CHARS = 1_000_000
# Documents of one batch; pairs of one row.
BATCH_DOCS = 2048
PAIR_ROWS = 65_536


def gallop(ends: np.ndarray, wanted: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The number of `ends` below each wanted offset; none is above the last end.

    Every search begins at its start and moves up or down in doubling steps until it is bracketed;
    a binary search ends it.
    """
    low, high = np.zeros(len(wanted), dtype=np.int64), np.full(len(wanted), len(ends), dtype=np.int64)
    up = ends[start] < wanted
    low[up], high[~up] = start[up] + 1, start[~up]
    active, step = np.flatnonzero(up), 1
    while len(active):
        place = np.minimum(low[active] + step - 1, len(ends) - 1)
        short = ends[place] < wanted[active]
        high[active[~short]] = place[~short]
        active, step = active[short], 2 * step
        low[active] = place[short] + 1
    active, step = np.flatnonzero(~up & (high > 0)), 1
    while len(active):
        place = np.maximum(high[active] - step, 0)
        short = ends[place] < wanted[active]
        low[active[short]] = place[short] + 1
        active, place = active[~short], place[~short]
        high[active] = place
        active, step = active[place > 0], 2 * step
    active = np.flatnonzero(low < high)
    while len(active):
        middle = (low[active] + high[active]) // 2
        short = ends[middle] < wanted[active]
        low[active[short]], high[active[~short]] = middle[short] + 1, middle[~short]
        active = active[low[active] < high[active]]
    return low


def overlaps(driver: np.ndarray, other: np.ndarray, driver_sizes: np.ndarray, other_sizes: np.ndarray):
    """(first, last, shared) for each token of the driver, over texts that follow one another.

    `driver` and `other` are the token ends of all texts, `*_sizes` the tokens of each text. A token
    overlaps the other side's tokens first to last; `shared` marks an end that is on both lists.
    """
    before = np.cumsum(driver_sizes) - driver_sizes
    local = np.arange(len(driver)) - np.repeat(before, driver_sizes)
    each = np.repeat(driver_sizes, driver_sizes), np.repeat(other_sizes, driver_sizes)
    start = np.repeat(np.cumsum(other_sizes) - other_sizes, driver_sizes) + local * each[1] // np.maximum(each[0], 1)
    last = gallop(other, driver, start)
    shared = other[last] == driver if len(driver) else np.zeros(0, dtype=bool)
    first = np.concatenate([[0], (last + shared)[:-1]]) if len(driver) else last
    return first, last, shared


@dataclass
class Aligned:
    """A batch of aligned texts; tokens, groups and links of all texts follow one another."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_sizes: np.ndarray
    b_sizes: np.ndarray
    group_sizes: np.ndarray
    link_sizes: np.ndarray
    a_ends: np.ndarray  # number of A tokens up to each group's end
    b_ends: np.ndarray
    link_a: np.ndarray  # token numbers of each link
    link_b: np.ndarray


class Aligner:
    """Both tokenizers with the bytes of their ids, loaded once per task."""

    def __init__(self, a_path: str, b_path: str):
        self.encode_a, self.model_b = tokenizer.plain_texts(a_path), tokenizer.sentence_pieces(b_path)
        by_id = tokenizer.pieces(a_path)
        self.a_pieces = pa.array([by_id.get(i, b"") for i in range(max(by_id) + 1)], pa.large_binary())
        self.b_pieces = pa.array(tokenizer.sentence_piece_bytes(b_path), pa.large_binary())
        self.a_lengths, self.b_lengths = (np.diff(np.frombuffer(p.buffers()[1], dtype=np.int64)) for p in (self.a_pieces, self.b_pieces))
        # Decimals of every id with each of the three separators.
        count = max(len(self.a_pieces), len(self.b_pieces))
        self.decimals = pa.array([b"%d%c" % (i, s) for i in range(count) for s in b",|;"], pa.large_binary())

    def _spells(self, pieces, lengths, ids: list, octets: list[bytes]) -> list[bool]:
        """Whether the ids of each text spell its bytes."""
        flat = np.concatenate([np.array(x, dtype=np.int64) for x in ids]) if ids else np.empty(0, np.int64)
        data = pieces.take(pa.array(flat)).buffers()[2]
        data, out, at = memoryview(data or b"").cast("B"), [], 0
        sizes = np.add.reduceat(np.append(lengths[flat], 0), np.cumsum([0, *map(len, ids)])[:-1]) if ids else []
        for size, found, own in zip(np.where([len(x) > 0 for x in ids], sizes, 0).tolist(), ids, octets):
            out.append(size == len(own) and data[at:at + size] == own)
            at += size
        return out

    def align(self, texts: list[str | None]) -> Aligned:
        bodies = [" " + t if t else "" for t in texts]
        some = [k for k, t in enumerate(texts) if t]
        a, b = [[] for _ in texts], [[] for _ in texts]
        for k, found in zip(some, self.model_b.encode([texts[k] for k in some], num_threads=1) if some else []):
            a[k], b[k] = self.encode_a(bodies[k]), found
        octets = [x.encode() for x in bodies]
        for k, fine in enumerate(zip(self._spells(self.a_pieces, self.a_lengths, a, octets), self._spells(self.b_pieces, self.b_lengths, b, octets))):
            if not all(fine):
                a[k], b[k] = [], []
        return self.linked(a, b)

    def linked(self, a: list, b: list) -> Aligned:
        """Groups and links of texts whose ids on both sides spell the same bytes."""
        a_sizes, b_sizes = (np.array([len(x) for x in side], dtype=np.int64) for side in (a, b))
        a_ids, b_ids = (np.concatenate([np.array(x, dtype=np.int64) for x in side] or [np.empty(0, np.int64)]) for side in (a, b))
        shape = np.zeros(len(a), dtype=np.int64)
        groups, links, parts = shape.copy(), shape.copy(), []
        # Texts in which A has fewer tokens, then the others: the shorter list drives.
        for a_drives in (True, False):
            mine = (a_sizes <= b_sizes) == a_drives
            in_a, in_b = np.flatnonzero(np.repeat(mine, a_sizes)), np.flatnonzero(np.repeat(mine, b_sizes))
            ends_a, ends_b = np.cumsum(self.a_lengths[a_ids[in_a]]), np.cumsum(self.b_lengths[b_ids[in_b]])
            if a_drives:
                first, last, shared = overlaps(ends_a, ends_b, a_sizes[mine], b_sizes[mine])
            else:
                first, last, shared = overlaps(ends_b, ends_a, b_sizes[mine], a_sizes[mine])
            width = last - first + 1
            near = np.repeat(np.arange(len(width)), width)
            far = np.arange(len(near)) + np.repeat(first - (np.cumsum(width) - width), width)
            ends = np.flatnonzero(shared), last[shared]
            if not a_drives:
                near, far, ends = far, near, ends[::-1]
            sizes = (a_sizes if a_drives else b_sizes)[mine]
            owner = np.repeat(np.flatnonzero(mine), sizes)
            groups += np.bincount(owner, shared, len(a)).astype(np.int64)
            links += np.bincount(owner, width, len(a)).astype(np.int64)
            # Back from the numbering of these texts to that of all.
            parts.append((in_a[ends[0]], in_b[ends[1]], in_a[near], in_b[far]))
        ends_a, ends_b, link_a, link_b = (np.concatenate(x) for x in zip(*parts))
        if len(a) and not (a_sizes <= b_sizes).all():
            order = np.argsort(ends_a, kind="stable")
            ends_a, ends_b = ends_a[order], ends_b[order]
            # Links rise on both sides, so two sorted runs are merged.
            order = np.argsort(link_a, kind="stable")
            link_a, link_b = link_a[order], link_b[order]
        return Aligned(a_ids, b_ids, a_sizes, b_sizes, groups, links, ends_a + 1, ends_b + 1, link_a, link_b)

    def group_digests(self, x: Aligned) -> list[str]:
        """The digest of each text's groups, written as `a1,a2|b1;a3|b2,b3`; '' without tokens."""
        a_each, b_each = np.diff(x.a_ends, prepend=0), np.diff(x.b_ends, prepend=0)
        total = len(x.a_ids) + len(x.b_ids)
        line = np.empty(total, dtype=np.int64)
        a_last, b_last = np.zeros(len(x.a_ids), dtype=np.int64), np.zeros(len(x.b_ids), dtype=np.int64)
        a_last[x.a_ends - 1], b_last[x.b_ends - 1] = 1, 2
        line[np.arange(len(x.a_ids)) + np.repeat(x.b_ends - b_each, a_each)] = 3 * x.a_ids + a_last
        line[np.arange(len(x.b_ids)) + np.repeat(x.a_ends, b_each)] = 3 * x.b_ids + b_last
        written = self.decimals.take(pa.array(line))
        if not total:
            return [""] * len(x.a_sizes)
        places, data = np.frombuffer(written.buffers()[1], dtype=np.int64), memoryview(written.buffers()[2])
        bounds = places[np.cumsum(np.concatenate([[0], x.a_sizes + x.b_sizes]))].tolist()
        return [hashlib.sha256(data[p:q - 1]).hexdigest() if q > p else "" for p, q in zip(bounds, bounds[1:])]

    def pairs(self, x: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, times): the distinct id pairs of each text's links; a pair is a * size of B + b."""
        wide = len(self.b_pieces)
        text = np.repeat(np.arange(len(x.a_sizes)), x.link_sizes)
        span = wide * len(self.a_pieces)
        key, times = np.unique(text * span + x.a_ids[x.link_a] * wide + x.b_ids[x.link_b], return_counts=True)
        return key // span, key % span, times


def _paths(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    import public_tokenizers

    return a_path or tokenizer.default_path(), b_path or public_tokenizers.path("piece_bpe_32k.model")


def _batches(source, limit: int):
    """Lists of (key, text) of bounded size from Arrow batches."""
    some, chars = [], 0
    for batch in source:
        for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            some.append(row)
            chars += len(row[1] or "")
            if chars >= limit or len(some) >= BATCH_DOCS:
                yield some
                some, chars = [], 0
    if some:
        yield some


def _source(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{id_column}`").cast("string").alias("key"), F.col(f"`{text}`").alias("text"))


def align(docs: DataFrame, id_column: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """(id, a_ids, b_ids, groups, links) of every row.

    `groups` holds (a_end, b_end), how many tokens of each side lie up to the end of each group, and
    `links` the pairs (a, b) of numbers of overlapping tokens.
    """
    a_path, b_path = _paths(a_path, b_path)
    two = lambda x, y: pa.list_(pa.struct([(x, pa.int32()), (y, pa.int32())]))
    schema = pa.schema([
        ("key", pa.string()), ("a_ids", pa.list_(pa.int32())), ("b_ids", pa.list_(pa.int32())),
        ("groups", two("a_end", "b_end")), ("links", two("a", "b")),
    ])

    def run(source):
        aligner = Aligner(a_path, b_path)
        for some in _batches(source, BATCH_CHARS):
            x, out = aligner.align([t for _, t in some]), []
            at = [np.cumsum(np.concatenate([[0], s])).tolist() for s in (x.a_sizes, x.b_sizes, x.group_sizes, x.link_sizes)]
            for k, (key, _) in enumerate(some):
                (a, b, g, n), (a2, b2, g2, n2) = ([c[i] for c in at] for i in (k, k + 1))
                out.append({
                    "key": key, "a_ids": x.a_ids[a:a2], "b_ids": x.b_ids[b:b2],
                    "groups": [{"a_end": p - a, "b_end": q - b} for p, q in zip(x.a_ends[g:g2].tolist(), x.b_ends[g:g2].tolist())],
                    "links": [{"a": p - a, "b": q - b} for p, q in zip(x.link_a[n:n2].tolist(), x.link_b[n:n2].tolist())],
                })
            yield pa.RecordBatch.from_pylist(out, schema)

    columns = "key string, a_ids array<int>, b_ids array<int>, groups array<struct<a_end:int,b_end:int>>, links array<struct<a:int,b:int>>"
    kind = docs.schema[id_column].dataType.simpleString()
    out = _source(docs, id_column, text).mapInArrow(run, columns)
    return out.select(F.col("key").cast(kind).alias(id_column), *out.columns[1:])


SIZES = ("n_a", "n_b", "n_groups", "n_links")


def write_blocks(docs: DataFrame, path: str, id_column: str, text: str, a_path: str, b_path: str, block_chars: int) -> DataFrame:
    """Align all documents and write, block by block, distinct pairs and what each document needs.

    A row holds either `pairs` with their `counts`, or a batch of documents: keys, sizes, digests,
    and for each its distinct `numbers` into the block's sorted pairs with `times`.
    """
    longs, texts = pa.list_(pa.int64()), pa.list_(pa.string())
    schema = pa.schema([
        ("block", pa.int64()), ("pairs", longs), ("counts", longs), ("keys", texts), *[(c, longs) for c in SIZES],
        ("digests", texts), ("distinct", longs), ("numbers", pa.binary()), ("times", pa.binary()),
    ])

    def run(source):
        aligner, part, serial = Aligner(a_path, b_path), TaskContext.get().partitionId(), 0
        held, chars = [], 0

        def flush():
            block = part << 32 | serial
            known = np.unique(np.concatenate([pair for *_, pair, _ in held]))
            counts = np.zeros(len(known), dtype=np.int64)
            for row, distinct, pair, times in held:
                number = np.searchsorted(known, pair)
                counts += np.bincount(number, times, len(known)).astype(np.int64)
                # Numbers rise within a document: only their steps are kept.
                steps = np.diff(number, prepend=0)
                begins = (np.cumsum(distinct) - distinct)[distinct > 0]
                steps[begins] = number[begins]
                yield pa.RecordBatch.from_pylist([{
                    "block": block, **row, "distinct": distinct, "numbers": pack_numbers(steps), "times": pack_numbers(times),
                }], schema)
            for at in range(0, len(known), PAIR_ROWS):
                some = slice(at, at + PAIR_ROWS)
                yield pa.RecordBatch.from_pylist([{"block": block, "pairs": known[some], "counts": counts[some]}], schema)

        for some in _batches(source, BATCH_CHARS):
            x = aligner.align([t for _, t in some])
            sizes = dict(zip(SIZES, (x.a_sizes, x.b_sizes, x.group_sizes, x.link_sizes)))
            row = {"keys": [k for k, _ in some], **sizes, "digests": aligner.group_digests(x)}
            doc, pair, times = aligner.pairs(x)
            held.append((row, np.bincount(doc, minlength=len(some)), pair, times))
            chars += sum(len(t or "") for _, t in some)
            if chars >= block_chars:
                yield from flush()
                held, chars, serial = [], 0, serial + 1
        if held:
            yield from flush()

    longs, texts = "array<bigint>", "array<string>"
    columns = (
        f"block bigint, pairs {longs}, counts {longs}, keys {texts}, " + ", ".join(f"{c} {longs}" for c in SIZES)
        + f", digests {texts}, distinct {longs}, numbers binary, times binary"
    )
    _source(docs, id_column, text).mapInArrow(run, columns).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def link_counts(blocks: DataFrame) -> DataFrame:
    """(pair, n): how many links of the whole corpus hold each id pair."""
    return _named_pairs(blocks).groupBy("pair").agg(F.sum("n").alias("n"))


def _named_pairs(blocks: DataFrame) -> DataFrame:
    """(block, pair, n): the distinct pairs of each block."""
    rows = blocks.where("pairs IS NOT NULL").select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    return rows.select("block", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))


def _assemble(schema: pa.Schema):
    """Look the links of a block's documents up among the totals of its pairs."""

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["pair"].to_numpy())
        n = right["n"].to_numpy()[order]
        best = right["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64)
        out = []
        for row in left.to_pylist():
            distinct = np.array(row["distinct"], dtype=np.int64)
            steps, times = unpack_numbers(row["numbers"]).astype(np.int64), unpack_numbers(row["times"]).astype(np.int64)
            run, ends = np.cumsum(steps), np.cumsum(distinct)
            begins = ends - distinct
            # Each document's numbers start anew.
            number = run - np.repeat(np.concatenate([[0], run])[begins], distinct)
            sums = [np.concatenate([[0], np.cumsum(v)]) for v in (times * best[number], times * n[number])]
            n_best, count_sum = (s[ends] - s[begins] for s in sums)
            out.append(pa.Table.from_arrays([
                pa.array(v, f.type) for v, f in
                zip((row["keys"], *(row[c] for c in SIZES), n_best, count_sum, row["digests"]), schema)
            ], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return join


def alignment_counts(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    a_path, b_path = _paths(a_path, b_path)
    spark, wide = docs.sparkSession, len(tokenizer.sentence_piece_bytes(b_path))
    blocks = write_blocks(docs, scratch_path(spark, "aligned"), id_column, text, a_path, b_path, block_chars)
    totals = stored(link_counts(blocks))
    b_id = F.pmod("pair", F.lit(wide)).alias("b")
    # At most one row per id of the B vocabulary.
    highest = totals.groupBy(b_id).agg(F.max("n").alias("most"))
    judged = totals.select("pair", "n", b_id).join(F.broadcast(highest), "b")
    judged = judged.select("pair", F.col("n").alias("total"), (F.col("n") == F.col("most")).alias("best"))
    named = _named_pairs(blocks).select("block", "pair").join(judged, "pair").select("block", "pair", F.col("total").alias("n"), "best")
    schema = pa.schema([("key", pa.string()), *[(c, pa.int64()) for c in (*SIZES, "n_best", "count_sum")], ("groups_sha256", pa.string())])
    columns = "key string, " + ", ".join(f"{c} bigint" for c in (*SIZES, "n_best", "count_sum")) + ", groups_sha256 string"
    batches = blocks.where("keys IS NOT NULL").drop("pairs", "counts").withColumnRenamed("block", "owner")
    out = batches.groupBy("owner").cogroup(named.groupBy("block")).applyInArrow(_assemble(schema), columns)
    kind = docs.schema[id_column].dataType.simpleString()
    return out.select(F.col("key").cast(kind).alias(id_column), *out.columns[1:])
