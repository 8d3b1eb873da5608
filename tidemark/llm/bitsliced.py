"""Exact top-k inner products over a bit-sliced index.

Vectors become integers, floor(scale * x). The index cuts the rows into blocks of bounded size; a
block holds, for each component, one bitmap per bit of the value above the block's minimum.

A query adds the bitmaps of all components, each shifted by the bits of the query's weight, with
carry-save adders made of AND, OR and XOR: the result is a bit-sliced score of every row of the
block. Only the upper slices are added; the lower `dropped` bits bound the score's error. The k-th
largest coarse score is read from the most significant slice downward, every row that could still
reach it within the error is selected by a bit-sliced comparison, and these boundary rows get their
exact integer scores. Each block returns k rows per query, and a window picks the k best of all.

All queries meet all rows, block by block: both sides are copied to (block, chunk of queries)
pairs, whose memory is bounded by the two sizes. Nothing is broadcast or collected, and no row is
left out: the result is exact.

Defined results: rows whose vector or id is NULL, or that hold a NULL or non-finite component, take
no part; vectors of another length than the query's are no candidates; a query row that repeats an
id is asked once, with its smallest vector, and all rows of its id are its own; other repeated rows
are candidates as often as they occur. Scores are exact whatever the components; a quantised component of
2^62 or more, or a returned score that doesn't fit a long, stops the job. Ties go to the smaller id;
only the two named columns are read, whatever others are called; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

BLOCK_ROWS = 8192
CHUNK_QUERIES = 1024
# Queries that are added together.
BATCH = 32
DROPPED = 2


def quantised(vectors: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """(id, v) with integer components, for the rows that take part."""
    values = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    named = vectors.select(F.col(f"`{id_column}`").alias("id"), values.alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = named.where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))
    large = F.raise_error(F.lit("a component is too large to be indexed")).cast("long")
    whole = lambda x: F.when(F.abs(x * scale) < F.lit(2.0 ** 62), F.floor(x * scale).cast("long")).otherwise(large)
    return kept.select("id", F.transform("x", whole).alias("v"))


def _products(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows with one weight vector."""
    if float(np.abs(rows).max(initial=0)) * float(np.abs(weights).max(initial=0)) * max(1, len(weights)) < 2.0 ** 62:
        return rows @ weights
    return np.array([sum(a * b for a, b in zip(row, weights.tolist())) for row in rows.tolist()], dtype=object)


def _slices(rows: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (component, bit, 64-bit word) of non-negative rows (row, component)."""
    n, dims = rows.shape
    words = -(-n // 64)
    out = np.zeros((dims, width, words * 8), dtype=np.uint8)
    for bit in range(width):
        packed = np.packbits(((rows >> bit) & 1).astype(np.uint8).T, axis=1, bitorder="little")
        out[:, bit, :packed.shape[1]] = packed
    return out.view(np.uint64)


def _index_block(key, rows):
    """One row with the ids, the exact values and the slices of a block."""
    rows = rows.sort_values("id", kind="stable")
    values = np.array(rows["v"].tolist(), dtype=np.int64).reshape(len(rows), key[0])
    base = values.min(axis=0)
    width = max(1, int((values - base).max()).bit_length()) if key[0] else 1
    return pd.DataFrame([{
        "dims": key[0], "block": key[1], "width": width, "ids": rows["id"].to_numpy(np.int64).tobytes(),
        "exact": values.tobytes(), "slices": _slices(values - base, width).tobytes(),
    }])


def build_index(rows: DataFrame, blocks: int) -> DataFrame:
    """The index of stored (id, v): a row per vector length and block, dealt by a hash of the id and a row number."""
    block = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    dealt = rows.select(F.size("v").alias("dims"), block.alias("block"), "id", "v")
    return dealt.groupBy("dims", "block").applyInPandas(
        _index_block, "dims int, block int, width int, ids binary, exact binary, slices binary"
    )


def add_slices(slices: np.ndarray, weights: np.ndarray) -> tuple[list[np.ndarray], int]:
    """(bit slices of U, K): the weighted sum of each row for each query is U - K.

    `slices` is (component, bit, word), `weights` (query, component). Weights are in two's
    complement; their sign bits count negatively: as -x = (1 - x) - 1, complements are added, and K
    collects the ones, alike for all rows and queries.
    """
    queries, (dims, width, words) = len(weights), slices.shape
    bits = max(int(abs(int(w))).bit_length() for w in (weights.min(initial=0), weights.max(initial=0))) + 1
    every, none = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0)
    waiting: list[list[np.ndarray]] = [[]]

    def push(column: int, bitmap: np.ndarray) -> None:
        while True:
            while len(waiting) <= column:
                waiting.append([])
            pending = waiting[column]
            pending.append(bitmap)
            if len(pending) < 3:
                return
            x, y, z = pending
            half = x ^ y
            waiting[column] = [half ^ z]
            column, bitmap = column + 1, (x & y) | (z & half)

    constant = 0
    for bit in range(bits):
        masks = np.where((weights >> bit) & 1, every, none).astype(np.uint64)
        for j in range(dims):
            mask = masks[:, j, None]
            for s in range(width):
                bitmap = mask & slices[j, s]
                if bit == bits - 1:
                    bitmap = ~bitmap
                    constant += 1 << (bit + s)
                push(bit + s, bitmap)
    out, column = [], 0
    while column < len(waiting):
        pending = waiting[column]
        if len(pending) == 2:
            x, y = pending
            waiting[column] = [x ^ y]
            push(column + 1, x & y)
        out.append(waiting[column][0] if waiting[column] else np.zeros((queries, words), dtype=np.uint64))
        column += 1
    return out, constant


def select_rows(total: list[np.ndarray], valid: np.ndarray, k: int, slack: np.ndarray) -> np.ndarray:
    """Bitmaps of the valid rows whose sum is at least the k-th largest less the query's slack.

    `valid` is one bitmap for all queries or one for each.
    """
    queries = len(slack)
    above, level = np.zeros_like(total[0]), np.broadcast_to(valid, total[0].shape).copy()
    kth = [0] * queries
    for column in range(len(total) - 1, -1, -1):
        ones = level & total[column]
        found = above | ones
        enough = np.bitwise_count(found).sum(axis=1) >= k
        above = np.where(enough[:, None], above, found)
        level = np.where(enough[:, None], ones, level & ~total[column])
        for q in np.flatnonzero(enough).tolist():
            kth[q] |= 1 << column
    least = [max(0, kth[q] - int(slack[q])) for q in range(queries)]
    greater, equal = np.zeros_like(total[0]), np.broadcast_to(valid, total[0].shape).copy()
    for column in range(len(total) - 1, -1, -1):
        one = np.array([(x >> column) & 1 for x in least], dtype=bool)[:, None]
        greater = np.where(one, greater, greater | (equal & total[column]))
        equal = np.where(one, equal & total[column], equal & ~total[column])
    return greater | equal


def _search(k: int, dropped: int):
    columns = {"query_id": "int64", "vec_id": "int64", "score": "int64"}

    def search(key, blocks, asked):
        out = []
        for block in blocks.itertuples():
            ids = np.frombuffer(block.ids, dtype=np.int64)
            n, dims = len(ids), key[0]
            exact = np.frombuffer(block.exact, dtype=np.int64).reshape(n, dims)
            words = -(-n // 64)
            low = min(dropped, block.width - 1)
            slices = np.frombuffer(block.slices, dtype=np.uint64).reshape(dims, block.width, words)[:, low:]
            valid = _slices(np.ones((n, 1), dtype=np.int64), 1)[0, 0]
            for at in range(0, len(asked), BATCH):
                some = asked.iloc[at:at + BATCH]
                weights = np.array(some["v"].tolist(), dtype=np.int64).reshape(len(some), dims)
                # A query's own rows are no candidates, however many they are; they leave before the k-th is read.
                open_rows = np.repeat(valid[None], len(some), axis=0)
                for q, own in enumerate(some["id"].tolist()):
                    for row in range(np.searchsorted(ids, own), np.searchsorted(ids, own, "right")):
                        open_rows[q, row >> 6] &= ~(np.uint64(1) << np.uint64(row & 63))
                if dims:
                    total, _ = add_slices(slices, weights)
                    # The dropped bits add between sum of negative and sum of positive weights.
                    error = np.abs(weights.astype(object)).sum(axis=1) * ((1 << low) - 1)
                    slack = np.array([-(-int(e) // (1 << low)) for e in error], dtype=object)
                    chosen = select_rows(total, open_rows, k, slack)
                else:
                    chosen = open_rows
                picked = np.unpackbits(np.ascontiguousarray(chosen).view(np.uint8), axis=1, count=n, bitorder="little")
                for q, own in enumerate(some["id"].tolist()):
                    place = np.flatnonzero(picked[q])
                    score = _products(exact[place], weights[q])
                    if score.dtype == object:
                        best = sorted(range(len(score)), key=lambda i: (-score[i], ids[place[i]]))[:k]
                        if any(abs(score[i]) >= 1 << 63 for i in best):
                            raise OverflowError("a score does not fit a long")
                    else:
                        best = np.lexsort((ids[place], -score))[:k]
                    out.append(pd.DataFrame({"query_id": own, "vec_id": ids[place][best], "score": score[best].astype(np.int64)}))
        return pd.concat(out).astype(columns) if out else pd.DataFrame(columns=list(columns)).astype(columns)

    return search


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector: str = "embedding", scale: int = 256,
    block_rows: int = BLOCK_ROWS, chunk_queries: int = CHUNK_QUERIES, dropped: int = DROPPED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows, ties to the smaller id.

    `is_query` is a condition on the column `id`.
    """
    rows = stored(quantised(vectors, id_column, vector, scale))
    blocks = max(1, -(-rows.count() // block_rows))
    index = stored(build_index(rows, blocks))
    queries = rows.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
    chunks = max(1, -(-queries.count() // chunk_queries))
    dealt = queries.select("id", "v", F.size("v").alias("dims"), F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk"))
    asked = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    copies = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    pair = ["dims", "block", "chunk"]
    found = copies.groupBy(*pair).cogroup(asked.groupBy(*pair)).applyInPandas(
        _search(k, dropped), "query_id bigint, vec_id bigint, score bigint"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
