"""The closest pair between clusters and the widest pair within one, with few pairs compared.

Rows are packed into blocks of one cluster that lie near one another: each row goes to the nearest of
at most `PIVOTS` rows, and a (cluster, pivot) cell is halved along its widest dimension until a block
has at most `BLOCK_ROWS` rows, so that blocks shrink in space as rows are added. A
block has a centre and a radius, so the triangle inequality bounds every distance between two blocks
from below and above, by their centres alone. One real row of each block, the nearest to its centre,
gives first extremes; only block pairs whose bound can still beat the best pair found are candidates.
They are compared in order of promise, a few first, and each round's result discards more of the rest.
The extremes are exact: a pair is left out only if its bound proves it no better.

Blocks are dealt to shelves, about `SHELVES` of them, and the candidates of two shelves are compared in
one task. A block is copied once for each shelf that it meets, not once for each candidate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

PIVOTS = 1024
BLOCK_ROWS = 1_000
# Rows whose nearest pivots are found at once.
STEP_ROWS = 1_024
# Blocks that one task cuts from a cell, and the numbers in them at most.
CELL_BLOCKS, CELL_VALUES = 64, 1 << 22
# Shelves of balls, and the numbers that a shelf holds at most: beyond, there are more shelves.
SHELVES, SHELF_VALUES = 32, 1 << 21
# Balls of one chunk; chunks of balls meet pair by pair.
CHUNK_BALLS = 1_000
# Block pairs of each kind that the rounds take, the most promising first; the last takes what is left.
ROUNDS = (64, 512, None)
# Bounds are widened by this share of their terms, more than their rounding.
SLACK = 1e-12


@dataclass
class Extremes:
    """The closest pair of different clusters, the widest of one (None: no such pair), and the work done."""

    closest: float | None
    widest: float | None
    pairs: int
    compared: int


def pair_distances(a: np.ndarray, b: np.ndarray, manhattan: bool) -> np.ndarray:
    """All distances between the rows of two matrices, without cancellation."""
    if manhattan:
        return np.stack([np.abs(b - x).sum(axis=1) for x in a])
    return np.sqrt(np.stack([((b - x) ** 2).sum(axis=1) for x in a]))


def _squares(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """All squared distances as one matrix product, and a bound of their errors. Both matrices are
    moved to their common middle first, as the error grows with the lengths."""
    middle = (x.mean(axis=0) + y.mean(axis=0)) / 2
    x, y = x - middle, y - middle
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    left = np.column_stack([x, xx, np.ones(len(x))])
    right = np.column_stack([-2 * y, np.ones(len(y)), yy])
    # The differences to the middle are rounded as well, by half a unit of the numbers moved.
    moved = np.abs(middle).max() * np.sqrt(len(middle)) * np.sqrt(xx.max() + yy.max())
    return left @ right.T, 4 * (x.shape[1] + 4) * np.finfo(float).eps * (xx.max() + yy.max() + moved)


def extreme_distance(x: np.ndarray, y: np.ndarray, manhattan: bool, widest: bool, best: float) -> float:
    """The least (or largest) distance between the rows of two matrices, without cancellation; `best`
    if none beats it. Only the pairs that the product's error leaves open are measured again."""
    pick, better = (max, np.max) if widest else (min, np.min)
    if not manhattan:
        with np.errstate(all="ignore"):
            d, error = _squares(x, y)
            end = float(better(d))
        if np.isfinite(end) and np.isfinite(error):
            square = best * abs(best)
            if end + error < square * (1 - SLACK) if widest else end - error > square * (1 + SLACK):
                return best
            i, j = np.nonzero(d >= end - 2 * error if widest else d <= end + 2 * error)
            for at in range(0, len(i), 10_000):
                some = slice(at, at + 10_000)
                best = pick(best, float(better(np.sqrt(((y[j[some]] - x[i[some]]) ** 2).sum(axis=1)))))
            return best
    return pick(best, float(better(pair_distances(x, y, manhattan))))


def nearest_pivot(rows: np.ndarray, pivots: np.ndarray, manhattan: bool) -> np.ndarray:
    """The pivot nearest to each row, by one matrix product for euclidean distances. Its rounding can only
    move a row to a pivot about as near: cells are measured as they are, so the extremes stay exact."""
    if manhattan:
        return pair_distances(pivots, rows, True).argmin(axis=0).astype(np.int32)
    middle = pivots.mean(axis=0)
    moved = pivots - middle
    with np.errstate(all="ignore"):
        return ((moved * moved).sum(axis=1) - 2 * ((rows - middle) @ moved.T)).argmin(axis=1).astype(np.int32)


def _halves(rows: np.ndarray) -> Iterator[np.ndarray]:
    """The rows in parts of at most BLOCK_ROWS, by halving along the dimension that varies most."""
    if len(rows) <= BLOCK_ROWS:
        yield rows
        return
    middle = len(rows) // 2
    order = np.argpartition(rows[:, np.ptp(rows, axis=0).argmax()], middle)
    yield from _halves(rows[order[:middle]])
    yield from _halves(rows[order[middle:]])


def _packed(points: DataFrame, pivots: np.ndarray, manhattan: bool) -> DataFrame:
    """(ball, label, n, centre, radius, near, rows) of stored points (label, v)."""

    @F.arrow_udf("int")
    def nearest(v: pa.Array) -> pa.Array:
        rows = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)
        found = [nearest_pivot(rows[at:at + STEP_ROWS], pivots, manhattan) for at in range(0, len(rows), STEP_ROWS)]
        return pa.array(np.concatenate(found) if found else [], pa.int32())

    celled = stored(points.withColumn("cell", nearest("v")))
    parts = celled.groupBy("label", "cell").agg(
        F.ceil(F.count(F.lit(1)) / _cell_rows(pivots.shape[1])).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("v"), F.col("parts")).alias("part")
    dealt = celled.join(parts, ["label", "cell"]).select("label", "cell", part, "v")
    schema = pa.schema([
        ("label", pa.string()), ("n", pa.int64()), ("centre", pa.list_(pa.float64())), ("radius", pa.float64()),
        ("near", pa.list_(pa.float64())), ("rows", pa.list_(pa.float64())),
    ])

    def measure(table: pa.Table) -> pa.Table:
        label, found = table.column("label")[0].as_py(), []
        v = table.column("v").combine_chunks()
        for rows in _halves(v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)):
            centre = rows.mean(axis=0)
            away = pair_distances(centre[None], rows, manhattan)[0]
            found.append({
                "label": label, "n": len(rows), "centre": centre, "radius": away.max(),
                "near": rows[away.argmin()], "rows": rows.ravel(),
            })
        return pa.Table.from_pylist(found, schema)

    measured = dealt.groupBy("label", "cell", "part").applyInArrow(
        measure, "label string, n bigint, centre array<double>, radius double, near array<double>, rows array<double>"
    )
    return stored(measured.withColumn("ball", F.monotonically_increasing_id()))


def _cell_rows(dimensions: int) -> int:
    return max(BLOCK_ROWS, min(CELL_BLOCKS * BLOCK_ROWS, CELL_VALUES // max(dimensions, 1)))


def _chunk_pairs(balls: DataFrame) -> DataFrame:
    """Every unordered pair of chunks of balls, by an equi-join on the chunk to meet."""
    count = max(1, -(-balls.count() // CHUNK_BALLS))
    chunk = F.pmod(F.xxhash64("ball"), F.lit(count)).cast("int").alias("chunk")
    chunks = stored(balls.drop("rows").groupBy(chunk).agg(F.collect_list(F.struct("ball", "label", "n", "centre", "radius", "near")).alias("balls")))
    left = chunks.select(F.col("chunk").alias("left"), F.col("balls").alias("mine"), F.explode(F.sequence("chunk", F.lit(count - 1))).alias("chunk"))
    return left.join(chunks, "chunk").withColumnRenamed("chunk", "right")


def _columns(balls: list[dict]) -> dict[str, np.ndarray]:
    return {k: np.array([b[k] for b in balls]) for k in ("ball", "label", "n", "radius", "centre", "near")}


def _over_chunks(pairs: DataFrame, emit, columns: str) -> DataFrame:
    """`emit(left, right, same)` for each chunk pair; `same` marks the pairs of balls to take once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a, b = _columns(row["mine"]), _columns(row["balls"])
                once = np.ones((len(a["ball"]), len(b["ball"])), dtype=bool)
                if row["left"] == row["right"]:
                    once = a["ball"][:, None] <= b["ball"][None]
                yield from emit(a, b, once)

    return pairs.mapInArrow(run, columns)


def _first_extremes(pairs: DataFrame, manhattan: bool) -> tuple[float | None, float | None]:
    """Extremes over one row of each ball."""

    def emit(a, b, once):
        d = pair_distances(a["near"], b["near"], manhattan)
        same = a["label"][:, None] == b["label"][None]
        other = once & ~same
        mine = once & same & (a["ball"][:, None] != b["ball"][None])
        yield pa.RecordBatch.from_pylist([{
            "closest": float(d[other].min()) if other.any() else None, "widest": float(d[mine].max()) if mine.any() else None,
        }], pa.schema([("closest", pa.float64()), ("widest", pa.float64())]))

    found = _over_chunks(pairs, emit, "closest double, widest double").agg(F.min("closest"), F.max("widest")).first()
    return found[0], found[1]


def _candidates(pairs: DataFrame, closest: float | None, widest: float | None, manhattan: bool) -> DataFrame:
    """(a, b, same, bound): ball pairs whose bound can beat the extremes found so far."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("same", pa.bool_()), ("bound", pa.float64())])
    closest, widest = math.inf if closest is None else closest, -1.0 if widest is None else widest

    def emit(a, b, once):
        d = pair_distances(a["centre"], b["centre"], manhattan)
        reach = a["radius"][:, None] + b["radius"][None]
        low, high = d - reach - SLACK * (d + reach), d + reach + SLACK * (d + reach)
        same = a["label"][:, None] == b["label"][None]
        alone = (a["ball"][:, None] == b["ball"][None]) & (a["n"][:, None] == 1)
        for mine, chosen, bound in ((False, once & ~same & (low < closest), low), (True, once & same & ~alone & (high > widest), high)):
            i, j = np.nonzero(chosen)
            yield pa.RecordBatch.from_arrays([
                pa.array(a["ball"][i], pa.int64()), pa.array(b["ball"][j], pa.int64()), pa.array(np.full(len(i), mine)),
                pa.array(bound[i, j], pa.float64()),
            ], schema=schema)

    return _over_chunks(pairs, emit, "a bigint, b bigint, same boolean, bound double")


def _compare(chosen: DataFrame, data: DataFrame, shelves: int, manhattan: bool, closest: float | None,
             widest: float | None) -> tuple[float | None, float | None, int]:
    """Extremes over all rows of the chosen ball pairs, and how many row pairs that were. The pairs
    of two shelves are taken in order of promise, until a bound is no better than what was found."""
    schema = pa.schema([("least", pa.float64()), ("most", pa.float64()), ("pairs", pa.int64())])

    def run(balls: pa.Table, pairs: pa.Table) -> pa.Table:
        balls, sizes = balls.combine_chunks(), balls.column("n").to_pylist()
        rows = balls.column("rows").combine_chunks()
        place = {ball: k for k, ball in enumerate(balls.column("ball").to_pylist())}
        least, most, work = math.inf if closest is None else closest, -1.0 if widest is None else widest, 0

        def matrix(ball: int) -> np.ndarray:
            k = place[ball]
            return rows[k].values.to_numpy(zero_copy_only=False).reshape(sizes[k], -1)

        order = sorted(zip(*[pairs.column(c).to_pylist() for c in ("bound", "a", "b", "same")]))
        for bound, a, b, _ in (p for p in order if not p[3]):
            if bound >= least:
                break
            x, y = matrix(a), matrix(b)
            least, work = extreme_distance(x, y, manhattan, False, least), work + len(x) * len(y)
        for bound, a, b, _ in reversed([p for p in order if p[3]]):
            if bound <= most:
                break
            x, y = matrix(a), matrix(b)
            most = extreme_distance(x, y, manhattan, True, most)
            work += len(x) * (len(x) - 1) // 2 if a == b else len(x) * len(y)
        return pa.Table.from_pylist([{
            "least": least if least < math.inf else None, "most": most if most >= 0 else None, "pairs": work}], schema)

    def shelf(ball: str):
        return F.pmod(F.xxhash64(ball), F.lit(shelves)).cast("int")

    met = chosen.select(
        "a", "b", "same", "bound", F.least(shelf("a"), shelf("b")).alias("low"), F.greatest(shelf("a"), shelf("b")).alias("high"))
    needed = met.select(F.col("low").alias("i"), F.col("high").alias("j"), F.explode(F.array("a", "b")).alias("ball")).distinct()
    carried = needed.join(data.select("ball", "n", "rows"), "ball")
    found = carried.groupBy("i", "j").cogroup(met.groupBy("low", "high")).applyInArrow(
        run, "least double, most double, pairs bigint").agg(F.min("least"), F.max("most"), F.coalesce(F.sum("pairs"), F.lit(0))).first()
    return found[0], found[1], found[2]


def _better(pick, *values):
    known = [v for v in values if v is not None]
    return pick(known) if known else None


def extremes(df: DataFrame, vector: Column, label: Column, manhattan: bool = False, pivots: int = PIVOTS) -> Extremes:
    """The extremes over the distinct rows (label, vector) of `df`; NULL vectors are left out."""
    points = stored(df.select(label.cast("string").alias("label"), vector.alias("v")).where("v IS NOT NULL").distinct())
    n = points.count()
    if n < 2:
        return Extremes(None, None, 0, 0)
    dimensions = len(points.first()["v"])
    chosen = points.orderBy(F.xxhash64("v", F.lit(1)), "v").limit(min(pivots, -(-n // _cell_rows(dimensions)))).collect()
    balls = _packed(points, np.array([r["v"] for r in chosen]), manhattan)
    shelf_rows = min(max(8 * BLOCK_ROWS, -(-n // SHELVES)), max(BLOCK_ROWS, SHELF_VALUES // max(dimensions, 1)))
    shelves = -(-n // shelf_rows)
    pairs = stored(_chunk_pairs(balls))
    closest, widest = _first_extremes(pairs, manhattan)
    left = stored(_candidates(pairs, closest, widest, manhattan))
    compared, order = 0, F.struct(F.when(F.col("same"), -F.col("bound")).otherwise(F.col("bound")).alias("o"), "a", "b")
    for size in ROUNDS:
        beats = F.when(F.col("same"), F.col("bound") > F.lit(-1.0 if widest is None else widest)).otherwise(
            F.col("bound") < F.lit(math.inf if closest is None else closest))
        left = left.where(beats)
        kinds = [left.where(F.col("same") == mine) for mine in (False, True)]
        chosen = [k.orderBy(order).limit(size) if size else k for k in kinds]
        least, most, work = _compare(stored(chosen[0].unionByName(chosen[1])), balls, shelves, manhattan, closest, widest)
        closest, widest, compared = _better(min, closest, least), _better(max, widest, most), compared + work
        if size:
            ends = [c.agg(F.max(order).alias("e")).first()["e"] for c in chosen]
            after = [F.lit(False) if e is None else order > F.struct(*[F.lit(x).alias(n) for x, n in zip(e, ("o", "a", "b"))]) for e in ends]
            left = left.where(F.when(F.col("same"), after[1]).otherwise(after[0]))
            if left.isEmpty():
                break
    return Extremes(closest, widest, n * (n - 1) // 2, compared)
