"""Hard negatives by the threshold algorithm over sorted lists.

Vectors become integers, floor(scale * x), and a row's score is its integer inner product with an
anchor. An anchor's positives are its best rows of the same label; each positive opens a window of
scores from `low` to `high` percent of its own, and its negatives are the best rows of other labels
inside the window.

Rows are cut into blocks of bounded size: the rows of a label share a block where they fit, and a hot
label is dealt over as many blocks as it needs. A block holds, for each dimension, the list of its
rows sorted by that component. An anchor reads the lists from the end that its component's sign
makes largest (sorted access), and every row that comes up first anywhere gets its exact score
(random access). The components at the reached depth, weighted by the anchor's, bound the score of
every row not yet seen. Reading stops once this threshold lies strictly below each window's k-th
score, or below the window itself where it holds fewer than k; a row that ties with the k-th is thus
always seen, and the result is exact. The depth doubles from one step to the next.

All anchors meet all blocks: both sides are copied to (block, chunk of anchors) pairs, whose memory
is bounded by the two sizes. Positives are searched only in the blocks of the anchor's label. Each
pair returns k rows per window, and a window function picks the k best of all blocks.

Defined results: rows with a NULL id, label or vector or with a NULL or non-finite component take no
part; vectors of another length than the anchor's are no candidates. An anchor row that repeats an
id is asked once, with its smallest label and vector, and all rows of its id are its own; other
repeated rows count as often as they occur. Equal scores go by the smaller id. A window of a
negative score is empty. Components of any size are multiplied exactly; a score that doesn't fit a
long stops the job. Only the named columns are read, whatever others are called; an empty table gives
no rows, and text plays no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.attach import attach
from tidemark.session import stored

BLOCK_ROWS = 8192
CHUNK_ANCHORS = 4096
# Entries of each list that the first step reads; every further step doubles the depth.
FIRST_DEPTH = 16
# Below this bound doubles add integers exactly.
EXACT = 2.0**53


def integer_rows(vectors: DataFrame, id_column: str, vector: str, label: Column, scale: int) -> DataFrame:
    """(id, label, v) of the rows that take part; `v` holds whole numbers as doubles."""
    values = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double"))
    named = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), label.cast("string").alias("label"), values.alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) != float("inf")))
    kept = named.where("id IS NOT NULL AND label IS NOT NULL").where(F.coalesce(finite, F.lit(False)))
    # A double of this size or more is whole already.
    whole = F.transform("x", lambda x: F.when(F.abs(x * scale) < EXACT, F.floor(x * scale).cast("double")).otherwise(x * scale))
    return kept.select("id", "label", whole.alias("v"))


class Block:
    """The rows of a block with a sorted list for each dimension, largest component first."""

    def __init__(self, ids, codes, names, values, order):
        self.ids, self.codes, self.names, self.values, self.order = ids, codes, names, values, order
        self.sorted = np.take_along_axis(values.T, order, axis=1)
        self.largest = float(np.abs(values).max(initial=0.0))
        self.wide = None

    def lists_for(self, weights: np.ndarray):
        """(values, sorted values, weights) in a type whose sums are exact."""
        if len(weights) * self.largest * float(np.abs(weights).max(initial=0.0)) < EXACT:
            return self.values, self.sorted, weights
        if self.wide is None:
            self.wide = _integers(self.values), _integers(self.sorted)
        return *self.wide, _integers(weights)


def _integers(numbers: np.ndarray) -> np.ndarray:
    out = np.empty(numbers.shape, dtype=object)
    out.ravel()[:] = [int(x) for x in numbers.ravel().tolist()]
    return out


def _best(scores: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """The k first by falling score, then by id."""
    if scores.dtype == object:
        place = sorted(range(len(scores)), key=lambda i: (-scores[i], ids[rows[i]]))[:k]
    else:
        place = np.lexsort((ids[rows], -scores))[:k]
    return scores[place], rows[place]


def threshold_search(block: Block, weights: np.ndarray, open_rows: np.ndarray, windows: list, k: int, depths: list | None = None):
    """[(scores, rows)] for each window: the k best open rows whose score lies in it.

    `windows` are pairs of lowest and highest score, None for no bound. `depths` notes how far the
    lists were read.
    """
    values, ordered, weights = block.lists_for(weights)
    n = len(block.ids)
    up, down = np.flatnonzero(weights > 0), np.flatnonzero(weights < 0)
    found = [(np.empty(0, dtype=values.dtype), np.empty(0, dtype=np.int64)) for _ in windows]
    # Rows that are not open count as seen: they are never scored.
    seen, depth, step = ~open_rows, 0, FIRST_DEPTH

    def bound(at):
        total = 0
        if len(up):
            total = total + weights[up] @ ordered[up, at]
        return total + weights[down] @ ordered[down, n - 1 - at] if len(down) else total

    def closed(threshold) -> bool:
        for (low, _), (scores, _) in zip(windows, found):
            if len(scores) == k:
                if threshold >= scores[-1]:
                    return False
            elif low is None or threshold >= low:
                return False
        return True

    threshold = bound(0) if n else 0
    while depth < n and not closed(threshold):
        reached = min(n, depth + step)
        if len(up) or len(down):
            before = seen.copy()
            seen[block.order[up, depth:reached].ravel()] = True
            seen[block.order[down, n - reached:n - depth].ravel()] = True
            fresh = np.flatnonzero(seen & ~before)
        else:
            # No component weighs: every score is 0.
            fresh, reached = np.flatnonzero(~seen), n
        scores = values[fresh] @ weights
        for w, (low, high) in enumerate(windows):
            inside = np.ones(len(fresh), dtype=bool)
            if low is not None:
                inside &= (scores >= low).astype(bool)
            if high is not None:
                inside &= (scores <= high).astype(bool)
            if inside.any():
                together = np.concatenate([found[w][0], scores[inside]]), np.concatenate([found[w][1], fresh[inside]])
                found[w] = _best(*together, block.ids, k)
        threshold, depth, step = bound(reached - 1), reached, 2 * step
    if depths is not None:
        depths.append(depth)
    return found


def build_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """(dims, block, ids, codes, names, exact, lists) of rows (id, label, v, block)."""
    schema = pa.schema([
        ("dims", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()), ("codes", pa.binary()),
        ("names", pa.list_(pa.string())), ("exact", pa.binary()), ("lists", pa.binary()),
    ])

    def build(key, table):
        dims, block = (int(k.as_py()) for k in key)
        ids = table["id"].to_numpy().astype(np.int64)
        labels = table["label"].combine_chunks().dictionary_encode()
        if isinstance(labels, pa.ChunkedArray):
            labels = labels.combine_chunks()
        values = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dims)
        lists = np.argsort(-values.T, axis=1, kind="stable").astype(np.int32)
        return pa.Table.from_pylist([{
            "dims": dims, "block": block, "ids": ids.tobytes(), "codes": labels.indices.to_numpy().astype(np.int32).tobytes(),
            "names": labels.dictionary.to_pylist(), "exact": values.tobytes(), "lists": lists.tobytes(),
        }], schema)

    return rows.select(F.size("v").alias("dims"), "block", "id", "label", "v").groupBy("dims", "block").applyInArrow(
        build, "dims int, block int, ids binary, codes binary, names array<string>, exact binary, lists binary"
    )


def _blocks_of(table: pa.Table):
    for row in table.to_pylist():
        ids, dims = np.frombuffer(row["ids"], dtype=np.int64), row["dims"]
        yield Block(
            ids, np.frombuffer(row["codes"], dtype=np.int32), row["names"],
            np.frombuffer(row["exact"], dtype=np.float64).reshape(len(ids), dims),
            np.frombuffer(row["lists"], dtype=np.int32).reshape(dims, len(ids)),
        )


def _search(k: int, low: int, high: int):
    """A task over the blocks and anchors (id, label, v, scores) of one pair.

    Without `scores` an anchor looks for rows of its own label, with them for rows of others in the
    window of each score.
    """
    schema = pa.schema([("anchor_id", pa.int64()), ("window", pa.int64()), ("found_id", pa.int64()), ("score", pa.int64())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        anchors = right.to_pylist() if left.num_rows else []
        for block in _blocks_of(left):
            code = {name: c for c, name in enumerate(block.names)}
            for a in anchors:
                same = block.codes == code.get(a["label"], -1)
                if a["scores"] is None:
                    open_rows, windows, named = same & (block.ids != a["id"]), [(None, None)], [None]
                else:
                    named = [p for p in a["scores"] if low * p <= high * p]
                    windows = [(-(-low * p // 100), high * p // 100) for p in named]
                    open_rows = ~same & (block.ids != a["id"])
                if windows and open_rows.any():
                    for p, (scores, rows) in zip(named, threshold_search(block, np.array(a["v"], dtype=np.float64), open_rows, windows, k)):
                        out += [(a["id"], p, i, int(s)) for s, i in zip(scores.tolist(), block.ids[rows].tolist())]
        columns = list(zip(*out)) if out else [[], [], [], []]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return search


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, k: int = 5, low: int = 80, high: int = 100,
    id_column: str = "vec_id", vector: str = "embedding", scale: int = 256, block_rows: int = BLOCK_ROWS,
    chunk_anchors: int = CHUNK_ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `is_anchor` is a condition on the column `id`, `label` an expression on the columns of `vectors`;
    `low` and `high` are percents of the positive's score.
    """
    rows = stored(integer_rows(vectors, id_column, vector, label, scale))
    blocks = max(1, -(-rows.count() // block_rows))
    place = lambda part: F.pmod(F.xxhash64("label", part), F.lit(blocks)).cast("int")
    labels = stored(rows.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.col("parts")).cast("int")
    numbered = attach(rows, labels, ["label"]).withColumn("part", part)
    index = stored(build_blocks(numbered.withColumn("block", place(F.col("part"))), blocks))

    asked = rows.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "v")).alias("a")).select("id", "a.label", "a.v")
    chunks = max(1, -(-asked.count() // chunk_anchors))
    chunk = F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")
    asked = stored(asked.select("id", "label", "v", F.size("v").alias("dims"), chunk.alias("chunk")))
    copies = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    pair, columns = ["dims", "block", "chunk"], "anchor_id bigint, window bigint, found_id bigint, score bigint"

    def searched(anchors: DataFrame, where: Column, count: int) -> DataFrame:
        dealt = anchors.withColumn("block", F.explode(where)).select(*pair, "id", "label", "v", "scores")
        found = copies.groupBy(*pair).cogroup(dealt.groupBy(*pair)).applyInArrow(_search(count, low, high), columns)
        best = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "found_id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)

    own = F.array_distinct(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), place))
    nothing = F.lit(None).cast("array<bigint>")
    found = searched(attach(asked, labels, ["label"]).withColumn("scores", nothing), own, positives)
    near = stored(found.select("anchor_id", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")))
    opened = near.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_set("positive_score").alias("scores"))
    far = searched(asked.join(opened, "id"), F.sequence(F.lit(0), F.lit(blocks - 1)), k).select(
        "anchor_id", F.col("window").alias("positive_score"), "rank", F.col("found_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return near.join(far, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
