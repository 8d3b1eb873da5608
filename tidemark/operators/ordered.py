"""Moving averages, sliding training windows, cumulative shares, ROC points."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import finite
from .ranking import POSITION, fits_one_task, join_on, join_summary, over_series, positions, running_sums

# Longest weight list written as separate lag and lead terms.
MAX_TERMS = 64


def _reach(length: int) -> tuple[int, int]:
    """Rows before and after the centre of a window of this length."""
    half = length // 2
    return (half, half) if length % 2 else (half, half - 1)


def moving_average(df: DataFrame, value: str, key: Sequence[str], order: Sequence[str],
                   weights: Sequence[float] | None, name: str) -> DataFrame:
    """Centred weighted mean of each series. Where the window leaves the series the remaining
    weights are rescaled. None means equal weights over the length of the series. Many unequal
    weights are applied by block convolution."""
    if weights is None:
        return _whole_length_average(df, value, key, order, name)
    before, after = _reach(len(weights))
    ordering = [F.col(c) for c in order]

    def build(rows: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*ordering)
        if len(set(weights)) == 1:
            return rows.withColumn(name, F.avg("__x").over(w.rowsBetween(-before, after)))
        if len(weights) <= MAX_TERMS:
            cells = [F.lead("__x", i - before).over(w) for i in range(len(weights))]
            used = [(F.lit(float(g)), c) for g, c in zip(weights, cells)]
            total = reduce(lambda a, b: a + b, [F.coalesce(g * c, F.lit(0.0)) for g, c in used])
            share = reduce(lambda a, b: a + b, [F.when(c.isNotNull(), g).otherwise(0.0) for g, c in used])
            return rows.withColumn(name, F.try_divide(total, share))
        return _convolved(rows, keys, weights, before, name)

    rows = df.withColumn("__x", finite(value))
    fits = fits_one_task(df, key)
    if len(set(weights)) > 1 and len(weights) > MAX_TERMS:
        rows = positions(rows, key, ordering, "__row", fits)
    done = over_series(rows, key, ordering, before, after, build, fits)
    return done.select(*[c for c in df.columns if c != name], name)


def block_convolution(x: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """The full convolution of a long series with a kernel, by transforms of overlapping blocks."""
    length = len(kernel)
    size = 1 << max(6, (4 * length - 1).bit_length())
    step, turned = size - length + 1, np.fft.rfft(kernel, size)
    out = np.zeros(len(x) + length - 1)
    for at in range(0, len(x), step):
        block = x[at:at + step]
        out[at:at + len(block) + length - 1] += np.fft.irfft(np.fft.rfft(block, size) * turned, size)[:len(block) + length - 1]
    return out


def _convolved(rows: DataFrame, keys: list[str], weights: Sequence[float], before: int, name: str) -> DataFrame:
    """Weighted means of rows ("__row", "__x") of each series or chunk, at a cost that grows with the
    rows times the logarithm of the number of weights."""
    kernel = np.asarray(weights, dtype=float)[::-1]
    after = len(kernel) - 1 - before
    kept = rows.drop(name)
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())])

    def means(table: pa.Table) -> pa.Table:
        table = table.sort_by("__row")
        n, x = table.num_rows, table["__x"].to_numpy(zero_copy_only=False).astype(float)
        there = ~np.isnan(x)
        x = np.where(there, x, 0.0)
        total, share = (block_convolution(v, kernel)[after:after + n] for v in (x, there.astype(float)))
        # What rounding leaves of a window without values, or of weights that cancel, is no share.
        seen = np.concatenate([[0], np.cumsum(there)])
        place = np.arange(n)
        some = seen[np.minimum(place + after + 1, n)] > seen[np.maximum(place - before, 0)]
        fine = some & (np.abs(share) > 1e-12 * np.abs(kernel).sum())
        mean = np.divide(total, share, out=np.zeros(n), where=fine)
        return table.append_column(name, pa.array(mean, mask=~fine))

    return kept.groupBy(*keys).applyInArrow(means, schema)


def _whole_length_average(df: DataFrame, value: str, key: Sequence[str], order: Sequence[str],
                          name: str) -> DataFrame:
    """Equal weights over a window as long as the series: differences of running sums."""
    x = finite(value)
    sums = running_sums(
        df, key, [F.col(c) for c in order],
        {"__row": F.lit(1), "__sum": F.coalesce(x, F.lit(0.0)), "__n": x.isNotNull().cast("long")})
    sizes = sums.groupBy(*key).agg(
        F.max("__row").alias("__length"), F.max_by("__sum", "__row").alias("__all"), F.max("__n").alias("__all_n"))
    rows = join_summary(sums, sizes, key)
    half = F.floor(F.col("__length") / 2)
    after = F.when(F.col("__length") % 2 == 1, half).otherwise(half - 1)
    ends = rows.select(*key, F.col("__row").alias("__at"), F.col("__sum").alias("__s"), F.col("__n").alias("__k"))
    # a window this long always reaches one end of the series: at the start it is the sum up to
    # its right edge, after that the total less the sum before its left edge
    starts = F.col("__row") - half <= 1
    edge = F.when(starts, F.least(F.col("__row") + after, F.col("__length"))).otherwise(F.col("__row") - half - 1)
    rows = rows.withColumn("__at", edge).withColumn("__starts", starts)
    rows = join_on(rows, ends, [*key, "__at"], "left")
    total = F.when(F.col("__starts"), F.col("__s")).otherwise(F.col("__all") - F.col("__s"))
    count = F.when(F.col("__starts"), F.col("__k")).otherwise(F.col("__all_n") - F.col("__k"))
    return rows.select(*[c for c in df.columns if c != name], F.try_divide(total, count).alias(name))


def window_horizon(df: DataFrame, x_names: Sequence[str], y_names: Sequence[str], key: Sequence[str],
                   order: Sequence[str], time: str, window: int = 1, horizon: int = 1, stride: int = 1,
                   include_last: bool = False) -> DataFrame:
    """Sliding training samples of each series.

    One row per sample: key, `start` (from 0), arrays `x_<name>` over the window
    and `y_<name>` over the horizon behind it, and the times `t_x`, `t_y`. When
    an input is also a target the horizon starts one row later. Starts stop
    before n - window - horizon (- 1 in that case); `include_last` adds the
    last windows that still fit.
    """
    shift = int(any(x in y_names for x in x_names))
    first = window - 1 + shift
    span = first + horizon
    ordering = [F.col(c) for c in order]
    fits = fits_one_task(df, key)
    numbered = positions(df, key, ordering, POSITION, fits)
    sizes = numbered.groupBy(*key).agg(F.max(POSITION).alias("__n"))
    rows = join_summary(numbered, sizes, key)

    def build(part: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(POSITION)
        inputs, targets = w.rowsBetween(0, window - 1), w.rowsBetween(first, span - 1)
        x = [F.collect_list(F.struct(*x_names, F.col(time).alias("__t"))).over(inputs).alias("__xs")]
        y = [F.collect_list(F.struct(*y_names, F.col(time).alias("__t"))).over(targets).alias("__ys")]
        return part.select("*", *x, *y)

    built = over_series(rows, key, ordering, 0, span, build, fits)
    start = F.col(POSITION) - 1
    limit = F.col("__n") - window - horizon - shift
    wanted = (start % stride == 0) & ((start <= limit) if include_last else (start < limit))
    return built.where(wanted).select(
        *key, start.alias("start"),
        *[F.col("__xs")[c].alias(f"x_{c}") for c in x_names], F.col("__xs")["__t"].alias("t_x"),
        *[F.col("__ys")[c].alias(f"y_{c}") for c in y_names], F.col("__ys")["__t"].alias("t_y"))


def cumulative_share(df: DataFrame, value: str, order: Sequence[Column], name: str = "share") -> DataFrame:
    """Running sum over the total, in the given order."""
    total = df.agg(F.sum(value)).first()[0]
    sums = running_sums(df, [], order, {"__sum": F.col(value)})
    return sums.select(*df.columns, (F.col("__sum") / F.lit(total)).alias(name))


def roc_curve(df: DataFrame, truth: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score from high to low, after the origin, whose
    threshold is NULL. Equal scores are merged before anything is ordered."""
    points = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum((F.col(truth) == 1).cast("long")).alias("p"), F.sum((F.col(truth) != 1).cast("long")).alias("n"))
    positive, negative = points.agg(F.sum("p"), F.sum("n")).first()
    sums = running_sums(points, [], [F.col("threshold").desc()], {"tp": F.col("p"), "fp": F.col("n")})

    def share(c: Column, total) -> Column:
        return F.try_divide(c.cast("double"), F.lit(total).cast("double"))

    curve = sums.select("threshold", share(F.col("fp"), negative).alias("fpr"), share(F.col("tp"), positive).alias("tpr"))
    zero = F.lit(0).cast("long")
    origin = points.agg(F.max("threshold").alias("m")).select(
        F.nullif(F.col("m"), F.col("m")).alias("threshold"), share(zero, 1).alias("fpr"), share(zero, 1).alias("tpr"))
    return origin.unionByName(curve)
