"""K-means with three distances, and cluster quality scores.

Centres are small (k x p numbers) and travel as constants; everything that
grows with the data stays in Spark.
"""

from __future__ import annotations

import itertools
import math
import warnings
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import complete, doubles, whole
from ..session import stored
from . import balls
from .ranking import join_summary, lowest_by_hash, running_sums

COSINE_NAMES = ("cosine_similarity", "cosine_dissimilarity")
DISTANCE_NAMES = ("euclidean", "manhattan", *COSINE_NAMES)


def _check_distance(distance: str) -> None:
    if distance not in DISTANCE_NAMES:
        raise ValueError(f"unknown distance: {distance}")


def _units(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=-1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        return m / length


def _to_each(x: np.ndarray, others: np.ndarray, distance: str) -> np.ndarray:
    """Distances of vector x to every row of `others`; similarity counts as 1 - similarity."""
    if distance == "euclidean":
        return np.sqrt(((others - x) ** 2).sum(axis=1))
    if distance == "manhattan":
        return np.abs(others - x).sum(axis=1)
    return 1.0 - _units(others) @ _units(x)


def _matrix(v: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column, all of one length, as a matrix; NULL rows are left out."""
    flat = v.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(v) - v.null_count, -1)


def _distances(points: np.ndarray, centres: np.ndarray, distance: str) -> np.ndarray:
    if distance in COSINE_NAMES:
        return 1.0 - _units(points) @ _units(centres).T
    return np.stack([_to_each(c, points, distance) for c in centres], axis=1)


NEAREST = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("distance", T.DoubleType())])


def nearest_centre(vector: Column | str, centres: Sequence[Sequence[float]], distance: str = "euclidean") -> Column:
    """Struct (label, distance) of the closest centre; equal distances take the lower label. Both are
    NULL for a NULL vector or one with a NULL or NaN element."""
    _check_distance(distance)
    table = np.asarray(centres, dtype=float)

    @F.arrow_udf(NEAREST)
    def nearest(v: pa.Array) -> pa.Array:
        there = v.is_valid().to_numpy(zero_copy_only=False)
        label, away = np.zeros(len(v), dtype=np.int32), np.zeros(len(v))
        if there.any():
            d = _distances(_matrix(v), table, distance)
            d = np.where(np.isnan(d), np.inf, d)
            label[there] = d.argmin(axis=1)
            away[there] = d.min(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(label, mask=~there), pa.array(away, mask=~there)], ["label", "distance"])

    return nearest(whole(vector))


def assign_clusters(df: DataFrame, vector: str, centres: Sequence[Sequence[float]],
                    distance: str = "euclidean", name: str = "cluster") -> DataFrame:
    return df.withColumn(name, nearest_centre(vector, centres, distance)["label"])


def distances_to(df: DataFrame, vector: str, references: Sequence[Sequence[float]], keep: Sequence[str],
                 distance: str = "euclidean") -> DataFrame:
    """(keep..., reference, distance): every row against a short list of reference vectors. Distances
    of an incomplete vector are NULL."""
    _check_distance(distance)
    table = np.asarray(references, dtype=float)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def all_distances(v: pa.Array) -> pa.Array:
        there = v.is_valid().to_numpy(zero_copy_only=False)
        found = iter(_distances(_matrix(v), table, distance) if there.any() else [])
        return pa.array([next(found) if t else [None] * len(table) for t in there], type=pa.list_(pa.float64()))

    return df.select(*keep, F.posexplode(all_distances(whole(vector))).alias("reference", "distance"))


def _vector(c: str) -> Column:
    return array_to_vector(doubles(c))


def update_centres(df: DataFrame, vector: str, label: str) -> DataFrame:
    """(label, centre, n): the mean of every cluster's complete vectors."""
    summary = Summarizer.metrics("mean", "count").summary(_vector(vector))
    return df.where(complete(vector)).groupBy(label).agg(summary.alias("__s")).select(
        label, vector_to_array("__s.mean").alias("centre"), F.col("__s.count").alias("n"))


def centre_list(df: DataFrame, vector: str, label: str) -> tuple[list, list[list[float]]]:
    """Labels in order and their mean vectors, for use as constants."""
    rows = sorted(update_centres(df, vector, label).collect(), key=lambda r: r[label])
    return [r[label] for r in rows], [list(r["centre"]) for r in rows]


# Passes of the seeding after the first row, and candidates that each takes per centre.
SEED_ROUNDS, OVERSAMPLED = 5, 2


def spread_start(df: DataFrame, vector: str, k: int, seed: int, distance: str) -> list[list[float]]:
    """k-means++ start by oversampling, in SEED_ROUNDS + 2 passes whatever k.

    Each pass draws OVERSAMPLED * k rows without replacement, with probability proportional to the
    squared distance to the candidates so far: a seeded race, in which the rows with the smallest
    exponential waiting times win. A last pass weighs the candidates by the rows nearest to them, and
    weighted k-means++ on the candidates alone, whose number depends on k only, picks k of them.
    """
    # The draw depends on a row's content, so that a rerun gives the same centres; equal rows are one
    # row that weighs as much as they do.
    named = df.where(complete(vector)).select(doubles(vector).alias("v"))
    rows = stored(named.groupBy("v").agg(F.count(F.lit(1)).alias("n")).withColumn("race", F.xxhash64("v")))

    def draw(step: int, away: Column | None, count: int) -> list[list[float]]:
        u = (F.xxhash64("race", F.lit(seed), F.lit(step)).bitwiseAND(F.lit((1 << 53) - 1)) + 0.5) / F.lit(float(1 << 53))
        # Waiting times in logarithms: no distance is too large or too small.
        wait = F.log(-F.log(u)) - F.log("n")
        if away is None:
            return [list(r["v"]) for r in rows.orderBy(wait, "v").limit(count).collect()]
        measured = rows.withColumn("away", away).where((F.col("away") > 0) & (F.col("away") < float("inf")))
        return [list(r["v"]) for r in measured.orderBy(wait - 2 * F.log("away"), "v").limit(count).select("v").collect()]

    candidates = draw(0, None, 1)
    if not candidates:
        return []
    for step in range(1, SEED_ROUNDS + 1):
        more = draw(step, nearest_centre("v", candidates, distance)["distance"], OVERSAMPLED * k)
        candidates += more
        if not more or k == 1:
            break
    near = rows.withColumn("at", nearest_centre("v", candidates, distance)["label"]).groupBy("at").agg(F.sum("n").alias("n"))
    weight = np.zeros(len(candidates))
    for r in near.collect():
        weight[r["at"]] = r["n"]
    points, rng = np.asarray(candidates, dtype=float), np.random.default_rng(seed)
    chosen, closest = [], np.full(len(points), np.inf)
    while len(chosen) < min(k, len(points)):
        # Squared distances, scaled by the largest.
        some = np.where(np.isfinite(closest), closest, 0.0) if chosen else np.ones(len(points))
        share = weight * (some / (some.max() or 1.0)) ** 2
        if not share.sum() > 0:
            break
        chosen.append(int(rng.choice(len(points), p=share / share.sum())))
        new = _to_each(points[chosen[-1]], points, distance)
        closest = np.minimum(closest, np.where(np.isnan(new), np.inf, np.maximum(new, 0.0)))
        closest[chosen] = 0.0
    return [candidates[i] for i in chosen]


def random_start(df: DataFrame, vector: str, k: int, seed: int) -> list[list[float]]:
    """k different rows in a seeded random order."""
    rows = df.select(doubles(vector).alias("__v")).distinct().orderBy(F.xxhash64("__v", F.lit(seed)), "__v").limit(k)
    return [list(r[0]) for r in rows.collect()]


def kmeans_fit(df: DataFrame, vector: str, k: int = 2, init: str = "k-means++", max_iter: int | None = None,
               distance: str = "euclidean", seed: int = 0) -> list[list[float]]:
    """Centres after Lloyd rounds. Centres are means whatever the distance; the rounds stop when
    no row changes its cluster, or after max_iter with a warning. With distances whose centres aren't
    means, rounds can come back to earlier centres: then the ones of the cycle with the smallest summed
    distance are the result. Incomplete vectors take no part.

    A job reads all rows, from matrices that are persisted once, and returns k sums a task and the rows
    near a border between two centres, at most CLOSE_VALUES numbers and a quarter of the rows. Until the centres have
    moved so far that another row could change its cluster, the next rounds need these rows only."""
    _check_distance(distance)
    df = df.where(complete(vector))
    if init not in ("k-means++", "random"):
        raise ValueError(f"unknown init: {init}")
    if distance == "euclidean" and init == "k-means++" and k > 1:
        most = FIRST_ROUNDS if max_iter is None else max_iter
        model = KMeans(k=k, maxIter=most, seed=seed, featuresCol="features", tol=0.0).fit(
            df.select(_vector(vector).alias("features")))
        centres = [[float(x) for x in c] for c in model.clusterCenters()]
        if model.summary.numIter < most:
            return centres
        if max_iter is not None:
            warnings.warn(f"k-means has not converged in {max_iter} rounds", RuntimeWarning, stacklevel=2)
            return centres
    else:
        centres = random_start(df, vector, k, seed) if init == "random" else spread_start(df, vector, k, seed, distance)
    if not centres:
        return centres
    rows = df.select(doubles(vector).alias("__v"))
    held = _held(rows)
    previous, seen, path = None, {}, []
    base, reach, step, room = None, 0.0, 0.0, 0
    try:
        for _ in itertools.count() if max_iter is None else range(max_iter):
            if base is None or not _moved(base, centres, distance) < reach:
                settled, close, reach = _round(held, centres, distance, CLOSE_STEPS * step, room)
                base = centres
            sums = settled + _sums(close, _nearest(close, np.asarray(centres), distance)[0], len(centres)) if len(close) else settled
            if not room:
                room = min(int(sums[:, -1].sum()) // 4, CLOSE_VALUES // (sums.shape[1] - 1))
            # Means that equal the centres to the last bit: no row has changed its cluster.
            means = [[x / r[-1] for x in r[:-1]] if r[-1] else None for r in sums.tolist()]
            if means == centres:
                break
            lost = [i for i, mean in enumerate(means) if mean is None]
            if lost:  # an empty cluster starts again at the row farthest from its centre
                near = rows.withColumn("__near", nearest_centre("__v", centres, distance))
                far = near.orderBy(F.col("__near.distance").desc(), "__v").limit(len(lost)).collect()
                for i, r in itertools.zip_longest(lost, far):
                    means[i] = list(r["__v"]) if r else centres[i]
            step = _moved(centres, means, distance)
            previous, centres = centres, means
            state = hash(tuple(round(x, 9) for c in centres for x in c))
            # Nearly equal centres twice in a row are the end, which the next round finds.
            path.append(previous)
            if state in seen and max(abs(x - y) for a, b in zip(previous, centres) for x, y in zip(a, b)) > 1e-6:
                cycle = path[seen[state]:]
                return cycle[int(np.argmin(_summed_distances(held, cycle, distance)))]
            seen.setdefault(state, len(path))
        else:
            warnings.warn(f"k-means has not converged in {max_iter} rounds", RuntimeWarning, stacklevel=2)
    finally:
        held.unpersist()
    return centres


# Rows that are measured at once.
STEP_ROWS = 4_096
# Rounds of Spark's k-means before the ones here.
FIRST_ROUNDS = 10
# Numbers of the rows near a border at most, and for how many steps of the last length they are to last.
CLOSE_VALUES, CLOSE_STEPS = 1 << 20, 16


def _held(rows: DataFrame) -> RDD:
    """The vectors `__v` as persisted matrices, dealt over all cores: every round reads them, so they
    are decoded once."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = np.ascontiguousarray(_matrix(batch.column(0)), dtype=float)
                yield pa.RecordBatch.from_pydict({"n": pa.array([len(m)], pa.int64()), "data": [m.tobytes()]})

    blocks = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism).mapInArrow(pack, "n bigint, data binary")
    return blocks.rdd.map(lambda r: np.frombuffer(r["data"]).reshape(r["n"], -1)).persist(StorageLevel.MEMORY_AND_DISK)


def _moved(old: list[list[float]], new: list[list[float]], distance: str) -> float:
    """By how much a row's distances to two centres can have come closer to each other, at most; NaN if
    a centre has no direction."""
    a, b = np.asarray(old, dtype=float), np.asarray(new, dtype=float)
    if distance in COSINE_NAMES:
        a, b = _units(a), _units(b)
    away = np.abs(a - b).sum(axis=1) if distance == "manhattan" else np.linalg.norm(a - b, axis=1)
    return float(np.sort(away)[-2:].sum() * (1 + 1e-9))


def _nearest(points: np.ndarray, centres: np.ndarray, distance: str) -> tuple[np.ndarray, np.ndarray]:
    """For every row the centre that is nearest by `_distances`, and by how much any other is farther, at least.
    Where a matrix product is too rough to tell, the distances are measured."""
    if len(centres) == 1:
        return np.zeros(len(points), dtype=np.int64), np.full(len(points), np.inf)
    with np.errstate(all="ignore"):
        if distance == "euclidean":
            middle = centres.mean(axis=0)
            x, c = points - middle, centres - middle
            xx, cc = np.einsum("ij,ij->i", x, x), (c * c).sum(axis=1)
            d = xx[:, None] + cc - 2 * (x @ c.T)
            size = xx + cc.max()
            rough = 1e-15 * (10 + len(middle)) * (size + np.sqrt(size) * np.linalg.norm(middle))
        elif distance == "manhattan":
            d = _distances(points, centres, distance)
            rough = 1e-15 * (10 + points.shape[1]) * (np.abs(points).sum(axis=1) + np.abs(centres).sum(axis=1).max())
        else:
            length = np.sqrt(np.einsum("ij,ij->i", points, points))
            d = 1.0 - (points @ _units(centres).T) / length[:, None]
            rough = np.full(len(points), 1e-15 * (10 + points.shape[1]))
        label = d.argmin(axis=1)
        two = np.partition(d, 1, axis=1)[:, :2]
        gap = two[:, 1] - two[:, 0]
        margin = gap - rough
        if distance == "euclidean":
            margin /= np.sqrt(np.maximum(two, 0.0) + rough[:, None]).sum(axis=1)
        unsure = np.flatnonzero(~((gap > rough) & np.isfinite(margin)))
        if len(unsure):
            measured = _distances(points[unsure], centres, distance)
            label[unsure] = np.where(np.isnan(measured), np.inf, measured).argmin(axis=1)
            margin[unsure] = 0.0
            if distance in COSINE_NAMES:  # a row without direction is the first centre's, wherever that is
                margin[unsure[length[unsure] == 0]] = np.inf
    return label, margin


def _sums(points: np.ndarray, label: np.ndarray, k: int) -> np.ndarray:
    """For every label the sum of its rows and, last, their number."""
    total = np.zeros((k, points.shape[1] + 1))
    order = np.argsort(label, kind="stable")
    found, first = np.unique(label[order], return_index=True)
    total[found, :-1] = np.add.reduceat(points[order], first, axis=0)
    total[:, -1] = np.bincount(label, minlength=k)
    return total


def _round(held: RDD, centres: list[list[float]], distance: str, reach: float, room: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(settled, close, reach). For every centre the sum of the rows nearest to it and, last, their number,
    without the close rows; these are nearer to another centre by less than `reach`. It is lowered so that
    they are `room` rows at most. One job, whose tasks return these sums and rows only."""
    table = np.asarray(centres, dtype=float)
    # Rows can be all close or none where distances are not finite.
    wanted, share = reach if math.isfinite(reach) else 0.0, room // held.getNumPartitions()

    def run(matrices: Iterable[np.ndarray]) -> Iterable[tuple[np.ndarray, np.ndarray, float]]:
        total, limit = np.zeros((len(table), table.shape[1] + 1)), wanted if share else 0.0
        close, labels, margins = np.empty((0, table.shape[1])), np.empty(0, dtype=np.int64), np.empty(0)
        for m in matrices:
            for at in range(0, len(m), STEP_ROWS):
                some = m[at:at + STEP_ROWS]
                label, margin = _nearest(some, table, distance)
                near = margin < limit
                if not near.all():
                    total += _sums(some[~near], label[~near], len(table))
                if near.any():
                    close, labels, margins = np.concatenate([close, some[near]]), np.concatenate([labels, label[near]]), np.concatenate([margins, margin[near]])
                if len(close) > share:
                    limit = float(np.partition(margins, share)[share])
                    near = margins < limit
                    total += _sums(close[~near], labels[~near], len(table))
                    close, labels, margins = close[near], labels[near], margins[near]
        yield total, close, limit

    parts = held.mapPartitions(run).collect()
    return np.add.reduce([t for t, _, _ in parts]), np.concatenate([c for _, c, _ in parts]), min(r for _, _, r in parts)


def _summed_distances(held: RDD, several: list[list[list[float]]], distance: str) -> np.ndarray:
    """The summed distance of all rows to their nearest centres, for several lists of centres, in one job."""
    tables = [np.asarray(centres, dtype=float) for centres in several]

    def run(matrices: Iterable[np.ndarray]) -> Iterable[np.ndarray]:
        total = np.zeros(len(tables))
        for m in matrices:
            for at in range(0, len(m), STEP_ROWS):
                for i, table in enumerate(tables):
                    d = _distances(m[at:at + STEP_ROWS], table, distance)
                    total[i] += np.where(np.isnan(d), np.inf, d).min(axis=1).sum()
        yield total

    return np.add.reduce(held.mapPartitions(run).collect())


def wcss(df: DataFrame, vector: str, label: str) -> DataFrame:
    """Sum of squared distances to the own cluster's mean: column `score` of one row."""
    df = df.where(complete(vector))
    summary = Summarizer.metrics("variance", "count").summary(_vector(vector))
    per_cluster = df.groupBy(label).agg(summary.alias("__s"))
    spread = F.aggregate(vector_to_array("__s.variance"), F.lit(0.0), lambda a, v: a + v)
    return per_cluster.agg(F.sum(spread * (F.col("__s.count") - 1)).alias("score"))


# Rows of a block at least; blocks that the rows are dealt into as long as a block holds at most so many
# numbers, both of its vectors and of its sums for all clusters.
BLOCK_ROWS, BLOCKS, BLOCK_VALUES = 1_000, 32, 1 << 21
# Rows of one block that are compared at once.
TILE_ROWS = 512
# Labels in a tile up to which a matrix product sums its distances.
TILE_LABELS = 16


def _tile(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances as one matrix product; those too small for its precision are measured again."""
    middle = x.mean(axis=0)
    a, b = x - middle, y - middle
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    left, right = np.column_stack([a, aa, np.ones(len(a))]), np.column_stack([-2 * b, np.ones(len(b)), bb])
    with np.errstate(all="ignore"):
        d = left @ right.T
        moved = np.abs(middle).max() * np.sqrt(len(middle)) * np.sqrt(aa.max() + bb.max())
        small = 1e-5 * (aa.max() + bb.max() + moved)
        if d.min() > small and aa.max() + bb.max() < 1e300:
            return np.sqrt(d, out=d)
        i, j = np.nonzero(~(d > small) | np.isinf(d))
        np.sqrt(np.maximum(d, 0.0, out=d), out=d)
        for at in range(0, len(i), 100_000):
            some = slice(at, at + 100_000)
            d[i[some], j[some]] = np.sqrt(((y[j[some]] - x[i[some]]) ** 2).sum(axis=1))
    return d


def _by_label(d: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The labels, which come in order, and the weighted sums of every row of `d` over the columns of each."""
    there, starts, each = np.unique(labels, return_index=True, return_inverse=True)
    if len(there) <= TILE_LABELS:
        table = np.zeros((len(labels), len(there)))
        table[np.arange(len(labels)), each] = weights
        with np.errstate(all="ignore"):
            sums = d @ table
        if np.isfinite(sums).all():
            return there, sums
    return there, np.add.reduceat(d * weights, starts, axis=1)


def _euclidean_points(df: DataFrame, vector: str, label: str, sizes: dict[str, int]) -> DataFrame:
    """(copies, size, own, b) of every distinct point: the summed distance to its cluster and the least
    mean distance to another.

    Copies are merged first, so a mass of equal rows is one row here, and the points are dealt into
    blocks. Each two blocks meet once, in one task, and serve both: a block is copied once for each block,
    and a pair returns one sum per point and cluster. The blocks' number stays the same as rows are added,
    until a block is full.
    """
    names = sorted(sizes)
    points = stored(
        df.select(F.col(label).cast("string").alias("label"), doubles(vector).alias("v"))
        .groupBy("label", "v").agg(F.count(F.lit(1)).alias("copies")))
    first = points.select(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("p")).first()
    n, most = first["n"], max(1, BLOCK_VALUES // max(first["p"] or 1, len(names)))
    count = max(1, -(-n // min(max(BLOCK_ROWS, -(-n // BLOCKS)), most)))
    code = {name: k for k, name in enumerate(names)}
    size = np.array([sizes[name] for name in names], dtype=float)
    block = F.pmod(F.xxhash64("v", "label"), F.lit(count)).cast("int").alias("block")
    # The blocks are stored: a point must keep its place in its block.
    blocks = stored(points.groupBy(block).agg(F.collect_list(F.struct("label", "v", "copies")).alias("rows")).select(
        "block", F.col("rows.label").alias("labels"), F.col("rows.copies").alias("copies"), F.flatten("rows.v").alias("values")))
    other = F.col("other")
    met = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).withColumns(
        {"low": F.least("block", other).cast("int"), "high": F.greatest("block", other).cast("int")}).drop("other")
    types = pa.schema([("block", pa.int32()), ("labels", pa.list_(pa.int32())), ("copies", pa.list_(pa.int64())), ("sums", pa.list_(pa.float64()))])

    def pair(table: pa.Table) -> pa.Table:
        sides = []
        for r in range(table.num_rows):
            labels = np.array([code[x] for x in table.column("labels")[r].as_py()], dtype=np.int32)
            copies = table.column("copies")[r].values.to_numpy()
            v = table.column("values")[r].values.to_numpy(zero_copy_only=False).reshape(len(labels), -1)
            order = np.argsort(labels, kind="stable")
            sides.append((table.column("block")[r].as_py(), order, labels[order], copies[order].astype(float), v[order], labels, copies))
        a, b = sides[0], sides[-1]
        itself = a is b
        sums = [np.zeros((len(s[2]), len(names))) for s in sides]
        for at in range(0, len(a[2]), TILE_ROWS):
            for to in range(0, len(b[2]), TILE_ROWS):
                mine, theirs = slice(at, at + TILE_ROWS), slice(to, to + TILE_ROWS)
                d = _tile(a[4][mine], b[4][theirs])
                there, some = _by_label(d, b[2][theirs], b[3][theirs])
                sums[0][mine, there] += some
                if not itself:
                    here, some = _by_label(d.T, a[2][mine], a[3][mine])
                    sums[1][theirs, here] += some
        found = []
        for s, total in zip(sides, sums):
            back = np.empty_like(total)
            back[s[1]] = total
            found.append({"block": s[0], "labels": s[5] if itself else None, "copies": s[6] if itself else None, "sums": back.ravel()})
        return pa.Table.from_pylist(found, types)

    parts = met.groupBy("low", "high").applyInArrow(pair, "block int, labels array<int>, copies array<bigint>, sums array<double>")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = labels = copies = None
        for batch in batches:
            for r in range(batch.num_rows):
                some = batch.column("sums")[r].values.to_numpy()
                sums = some.copy() if sums is None else np.add(sums, some, out=sums)
                if batch.column("labels")[r].is_valid:
                    labels = batch.column("labels")[r].values.to_numpy()
                    copies = batch.column("copies")[r].values.to_numpy()
        sums = sums.reshape(len(labels), -1)
        at = np.arange(len(labels))
        own, means = sums[at, labels], sums / size
        means[at, labels] = np.inf
        yield pa.RecordBatch.from_arrays(
            [pa.array(copies), pa.array(size[labels]), pa.array(own), pa.array(means.min(axis=1))], ["copies", "size", "own", "b"])

    return parts.groupBy("block").applyInArrow(total, "copies bigint, size double, own double, b double")


# Labels whose summed distances one pass keeps as columns.
PASS_LABELS = 64


def _points(df: DataFrame, vector: str, label: str) -> DataFrame:
    # the stored rows keep their partitions, so the ids stay the same in every later pass
    return stored(
        df.select(F.col(label).cast("string").alias("label"), doubles(vector).alias("v"))
        .groupBy("label", "v").agg(F.count(F.lit(1)).alias("copies"))
    ).withColumn("point", F.monotonically_increasing_id())


def _manhattan_sums(points: DataFrame, names: list[str]) -> DataFrame:
    """(point, label, copies, names, sums): summed manhattan distance of every distinct point to each cluster,
    without any pairs. Along one dimension the distances of x to all values of a cluster follow
    from the count and the sum of the values up to x, so running sums over the sorted values of
    each dimension are enough."""
    cells = points.select("point", "label", "copies", F.posexplode("v").alias("dimension", "x"))
    x = F.col("x")
    mine = [F.when(F.col("label") == n, F.col("copies")).otherwise(0) for n in names]
    levels = cells.groupBy("dimension", "x").agg(*[F.sum(m).alias(f"n{i}") for i, m in enumerate(mine)])
    sums = {f"b{i}": F.col(f"n{i}") for i in range(len(names))}
    sums |= {f"s{i}": F.col(f"n{i}") * x for i in range(len(names))}
    running = running_sums(levels, ["dimension"], [x], sums)
    whole = cells.groupBy("dimension").agg(
        *[F.sum(m).alias(f"all_n{i}") for i, m in enumerate(mine)],
        *[F.sum(m * x).alias(f"all_s{i}") for i, m in enumerate(mine)],
        *[F.sum(m * F.abs(x)).alias(f"all_a{i}") for i, m in enumerate(mine)])
    both = running.join(whole, "dimension")

    def total(i: int) -> Column:
        below, above = F.col(f"b{i}"), F.col(f"all_n{i}") - F.col(f"b{i}")
        return x * below - F.col(f"s{i}") + (F.col(f"all_s{i}") - F.col(f"s{i}")) - x * above

    def summands(i: int) -> Column:
        return F.abs(x) * F.col(f"all_n{i}") + F.col(f"all_a{i}")

    along = both.select(
        "dimension", "x", *[total(i).alias(f"d{i}") for i in range(len(names))],
        *[summands(i).alias(f"e{i}") for i in range(len(names))])
    per_point = cells.join(along, ["dimension", "x"]).groupBy("point", "label", "copies").agg(
        *[F.sum(f"{c}{i}").alias(f"{c}{i}") for i in range(len(names)) for c in "de"])
    # the rounding residue of a zero distance counts as zero, against the size of the summands
    return per_point.select("point", "label", "copies", F.array(*[
        F.when(F.abs(F.col(f"d{i}")) <= 1e-12 * F.col(f"e{i}"), 0.0).otherwise(F.col(f"d{i}")) for i in range(len(names))
    ]).alias("sums")).withColumn("names", F.array(*[F.lit(n) for n in names]))


def _length(vector: str) -> Column:
    return F.sqrt(F.aggregate(doubles(vector), F.lit(0.0), lambda a, x: a + x * x))


def _unit(v: Column) -> Column:
    """A complete vector of some length over that length, which is taken once a row."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def unit(v: pa.Array) -> pa.Array:
        there = v.is_valid().to_numpy(zero_copy_only=False)
        if not there.any():
            return pa.nulls(len(v), pa.list_(pa.float64()))
        units = _units(_matrix(v))
        ends = np.concatenate([[0], np.cumsum(there)]) * units.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(units.ravel()), mask=pa.array(~there))

    return unit(v)


def _cosine_sums(df: DataFrame, vector: str, label: str) -> DataFrame:
    """(label, names, sums) of every row: summed 1 - cosine similarity, without any pairs: a cluster's summed
    dissimilarity to x is its size less x times the sum of its unit vectors."""
    units = df.select(F.col(label).cast("string").alias("label"), _unit(doubles(vector)).alias("u"))
    clusters = sorted(update_centres(units, "u", "label").collect(), key=lambda r: r["label"])
    names, means = [r["label"] for r in clusters], [list(r["centre"]) for r in clusters]
    counts = np.asarray([r["n"] for r in clusters], dtype=float)
    totals = np.asarray(means) * counts[:, None]

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def to_clusters(u: pa.Array) -> pa.Array:
        if len(u) == 0:
            return pa.array([], type=pa.list_(pa.float64()))
        d = counts - _matrix(u) @ totals.T
        return pa.array(list(np.where(np.abs(d) < 1e-12 * (1 + counts), 0.0, d)), type=pa.list_(pa.float64()))

    return units.select("label", to_clusters("u").alias("sums")).withColumn("names", F.array(*[F.lit(n) for n in names]))


def _silhouette_value(a: Column, b: Column) -> Column:
    """(b - a) / max(a, b) of the mean distances to the own and the nearest other cluster."""
    return (
        F.when((a == 0) & (b == 0), 0.0).when(b == 0, -1.0).when(a == 0, 1.0)
        .otherwise((b - a) / F.greatest(a, b)))


def silhouette(df: DataFrame, vector: str, label: str, distance: str = "euclidean") -> DataFrame:
    """Mean of (b - a) / max(a, b): `score` of one row.

    Rows alone in their cluster are left out, for cosine also zero vectors, which have no
    direction; a single cluster scores 0. Cosine takes one pass over the rows, manhattan sorts
    every dimension once for each PASS_LABELS clusters. Euclidean
    has no short form: it compares blocks with blocks, at a cost that grows
    with the square of the number of distinct rows. Rows without a label are left out of it.
    """
    _check_distance(distance)
    df = df.where(complete(vector))
    if distance in COSINE_NAMES:
        df = df.where(_length(vector) > 0)
    sizes = df.groupBy(F.col(label).cast("string").alias("other")).agg(F.count(F.lit(1)).alias("size"))
    if distance != "euclidean":
        n = {r["other"]: r["size"] for r in sizes.collect()}
        names = sorted(n)
        size = F.create_map(*[F.lit(x) for pair in n.items() for x in pair]) if n else F.create_map()
        if distance in COSINE_NAMES:
            passes = [_cosine_sums(df, vector, label).withColumns({"copies": F.lit(1), "point": F.monotonically_increasing_id()})]
        else:
            stored_points = _points(df, vector, label)
            passes = [_manhattan_sums(stored_points, names[at:at + PASS_LABELS]) for at in range(0, len(names), PASS_LABELS)]
        found = []
        for rows in passes:
            pairs = F.arrays_zip(F.col("names"), F.col("sums"))
            own = F.get(F.filter(pairs, lambda p: p["names"] == F.col("label")), F.lit(0))["sums"]
            others = F.transform(F.filter(pairs, lambda p: p["names"] != F.col("label")),
                                 lambda p: p["sums"] / F.element_at(size, p["names"]))
            found.append(rows.select(
                "point", "copies", F.element_at(size, F.col("label")).alias("size"), own.alias("own"),
                F.array_min(others).alias("b")))
        points = found[0] if found else df.select(*[F.lit(None).cast("double").alias(c) for c in ("copies", "size", "own", "b")]).limit(0)
        if len(found) > 1:
            for more in found[1:]:
                points = points.unionByName(more)
            points = points.groupBy("point", "copies", "size").agg(F.max("own").alias("own"), F.min("b").alias("b"))
    else:
        n = {r["other"]: r["size"] for r in sizes.where(F.col("other").isNotNull()).collect()}
        if len(n) < 2:
            return df.sparkSession.createDataFrame([(0.0,)], "score double")
        points = _euclidean_points(df.where(F.col(label).isNotNull()), vector, label, n)
    a, b = F.col("a"), F.col("b")
    value = _silhouette_value(a, b)
    scored = points.where((F.col("size") > 1) & b.isNotNull()).withColumn("a", F.col("own") / (F.col("size") - 1))
    return scored.agg(F.coalesce(
        F.try_divide(F.sum(value * F.col("copies")), F.sum("copies").cast("double")), F.lit(0.0)).alias("score"))


def silhouette_estimate(df: DataFrame, vector: str, label: str, id_columns: Sequence[str], sample_rows: int = 2_000,
                        confidence: float = 0.999, seed: int = 0) -> DataFrame:
    """The euclidean silhouette from a stratified sample: (score, bound, n_sampled, n_rows) of one row.

    Every cluster gives its share of `sample_rows`, at least one row, by a hash of its id. A sampled
    row's distances are taken to all rows, in one pass, so its value is exact; the score is the mean of
    the clusters' means, weighted by their sizes. Values lie in [-1, 1], so by Hoeffding's inequality,
    with Serfling's factor for draws without replacement, the exact score lies within `bound` with
    the given confidence; a cluster that is sampled whole adds nothing to the bound. Rows alone in
    their cluster and incomplete vectors are left out, as is everything if there is one cluster.
    The sample and its sums, one number per sampled row and cluster, are all that leaves a task.
    """
    named = df.where(complete(vector)).select(F.col(label).cast("string").alias("label"), doubles(vector).alias("v"), *id_columns)
    sizes = stored(named.groupBy("label").agg(F.count(F.lit(1)).alias("size")))
    counted = sizes.where("size > 1")
    n_rows = counted.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    share = F.ceil(F.lit(float(sample_rows)) * F.col("n") / F.lit(float(max(n_rows, 1))))
    several = join_summary(named, counted, ["label"]).where(F.col("size").isNotNull())
    flagged = lowest_by_hash(several, ["label"], id_columns, seed, F.least(share, F.col("n")), "chosen")
    sample = flagged.where("chosen").select("label", "v").collect()
    schema = "score double, bound double, n_sampled bigint, n_rows bigint"
    if not sample or sizes.count() < 2:
        return df.sparkSession.createDataFrame([(0.0, 0.0, len(sample), n_rows)], schema)
    points = np.array([r["v"] for r in sample])
    squares = (points ** 2).sum(axis=1)
    types = pa.schema([("label", pa.string()), ("sums", pa.list_(pa.float64()))])

    def distances(batches):
        totals: dict = {}
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            rows, codes = _matrix(batch.column(1)), names.indices.to_numpy()
            for at in range(0, len(rows), 1_000):
                some, which = rows[at:at + 1_000], codes[at:at + 1_000]
                away = np.sqrt(np.maximum((some ** 2).sum(axis=1)[:, None] + squares - 2 * some @ points.T, 0))
                for code in np.unique(which).tolist():
                    name = names.dictionary[code].as_py()
                    totals[name] = totals.get(name, 0) + away[which == code].sum(axis=0)
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array(list(totals.values()), types.field(1).type)], schema=types)

    parts = named.select("label", "v").mapInArrow(distances, "label string, sums array<double>")
    cells = parts.select(F.col("label").alias("other"), F.posexplode("sums").alias("place", "total")).groupBy("other", "place").agg(F.sum("total").alias("total"))
    owners = df.sparkSession.createDataFrame([(k, r["label"]) for k, r in enumerate(sample)], "place int, label string")
    met = cells.join(owners, "place").join(sizes.select(F.col("label").alias("other"), "size"), "other")
    mine = F.col("other") == F.col("label")
    values = met.groupBy("place", "label").agg(
        F.max(F.when(mine, F.col("total") / (F.col("size") - 1))).alias("a"), F.min(F.when(~mine, F.col("total") / F.col("size"))).alias("b"))
    strata = values.withColumn("value", _silhouette_value(F.col("a"), F.col("b"))).groupBy("label").agg(
        F.avg("value").alias("mean"), F.count(F.lit(1)).alias("m")).join(sizes, "label")
    weight = F.col("size") / F.lit(float(n_rows))
    spread = F.lit(2.0 * math.log(2.0 / (1.0 - confidence))) * F.sum(
        weight * weight / F.col("m") * F.when(F.col("m") == F.col("size"), 0.0).otherwise(1.0 - (F.col("m") - 1) / F.col("size")))
    return strata.agg(
        F.sum(weight * F.col("mean")).alias("score"), F.sqrt(spread).alias("bound"), F.sum("m").alias("n_sampled"),
        F.lit(n_rows).cast("bigint").alias("n_rows"))


def dunn_details(df: DataFrame, vector: str, label: str, distance: str = "euclidean") -> DataFrame:
    """One row: the Dunn `score`, the distances `closest` and `widest` that it divides, the number of
    `pairs` of distinct rows and how many were `compared`; blocks whose bounds can't matter are not.

    For cosine the unit vectors' chords are compared, whose half square is the dissimilarity; zero
    vectors take no part. NULL vectors and those with NULL or NaN elements are left out.
    """
    _check_distance(distance)
    rows = df.where(complete(vector))
    v = doubles(vector)
    if distance in COSINE_NAMES:
        rows, v = rows.where(_length(vector) > 0), _unit(v)
    found = balls.extremes(rows, v, F.col(label), distance == "manhattan")
    closest, widest = found.closest, found.widest
    if distance in COSINE_NAMES:
        closest, widest = (x if x is None else x * x / 2 for x in (closest, widest))
    score = closest / widest if closest is not None and widest else 0.0
    return df.sparkSession.createDataFrame(
        [(score, closest, widest, found.pairs, found.compared)],
        "score double, closest double, widest double, pairs bigint, compared bigint")


def dunn(df: DataFrame, vector: str, label: str, distance: str = "euclidean") -> DataFrame:
    """Smallest distance between clusters over the largest within one; 0 if undefined."""
    return dunn_details(df, vector, label, distance).select("score")


Score = Callable[[DataFrame, str, str, str], DataFrame]

SCORES: dict[str, Score] = {
    "inertia": lambda df, vector, label, distance: wcss(df, vector, label),
    "silhouette": silhouette,
    "dunn": dunn,
}


def cluster_scores(df: DataFrame, vector: str, label: str, distance: str = "euclidean",
                   scores: dict[str, Score] | None = None) -> DataFrame:
    """One row with a column per score; own functions may be passed by name."""
    chosen = SCORES if scores is None else scores
    row = df.sparkSession.range(1)
    return row.select(*[f(df, vector, label, distance).select("score").scalar().alias(n) for n, f in chosen.items()])


def score(df: DataFrame, vector: str, label: str, metric: str = "inertia", distance: str = "euclidean") -> DataFrame:
    """The chosen score negated, so that larger is better for a search."""
    return SCORES[metric](df, vector, label, distance).select((-F.col("score")).alias("score"))


def elbow_test(train: DataFrame, vector: str, validation: DataFrame | None = None, ks: Sequence[int] = (2, 3, 4, 5),
               distances: Sequence[str] = ("euclidean",), scores: Sequence[str] = ("inertia",),
               seed: int = 0, max_iter: int | None = None) -> DataFrame:
    """Scores of a fit for every k and distance, on the validation rows (default: the training
    rows). One row per combination."""
    rows = train.select(vector).persist()
    checked = validation.select(vector) if validation is not None else rows
    chosen = {name: SCORES[name] for name in scores}
    results = []
    try:
        for distance in distances:
            for k in ks:
                centres = kmeans_fit(rows, vector, k, distance=distance, seed=seed, max_iter=max_iter)
                labelled = assign_clusters(checked, vector, centres, distance)
                row = cluster_scores(labelled, vector, "cluster", distance, chosen).first()
                results.append((k, distance, *[float(row[s]) for s in scores]))
    finally:
        rows.unpersist()
    columns = ", ".join(["n_clusters int", "distance string", *[f"{s} double" for s in scores]])
    return train.sparkSession.createDataFrame(results, columns)
