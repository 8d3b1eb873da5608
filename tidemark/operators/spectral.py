"""Fourier spectra and periodograms of many series, of any length.

Series that fit one task are transformed whole with NumPy. A longer series is
cut in the classic two-step way: its rows form a grid of about sqrt(n) by
sqrt(n), columns are transformed in parallel, turned by their twiddle factor,
and then the rows are transformed in parallel. Lengths without fitting factors
become a convolution of a power-of-two length (chirp transform).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import finite
from ..session import single_task_rows, stored
from .attach import attach
from .ranking import fits_one_task, join_on, join_summary, positions


def _key_fields(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


def _schema(df: DataFrame, keys: Sequence[str], *names: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(_key_fields(df, keys) + [T.StructField(n, t) for n, t in names])


def _keyed(pdf: pd.DataFrame, keys: Sequence[str], **columns) -> pd.DataFrame:
    length = len(next(iter(columns.values())))
    head = {k: [pdf[k].iloc[0]] * length for k in keys}
    return pd.DataFrame({**head, **columns})


_LONG, _DOUBLE = T.LongType(), T.DoubleType()


def _whole(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, k, re, im, s) from (keys, t, re, im, s): one NumPy transform per series."""

    def transform(pdf: pd.DataFrame) -> pd.DataFrame:
        s = int(pdf["s"].iloc[0])
        grid = np.zeros(s, dtype=complex)
        grid[pdf["t"].to_numpy()] = pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy()
        out = np.fft.fft(grid)
        return _keyed(pdf, keys, k=np.arange(s), re=out.real, im=out.imag, s=np.full(s, s))

    schema = _schema(rows, keys, ("k", _LONG), ("re", _DOUBLE), ("im", _DOUBLE), ("s", _LONG))
    return rows.groupBy(*keys).applyInPandas(transform, schema)


def near_square_factor(n: int) -> int:
    """The largest divisor of n that is not above its square root."""
    return next(d for d in range(math.isqrt(n), 0, -1) if n % d == 0)


def _grid(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As _whole, in two parallel steps. Column `n1` divides s; absent positions count as zero."""
    n2 = (F.col("s") / F.col("n1")).cast("long")
    cells = rows.withColumn("n2", n2).withColumn("t2", F.col("t") % F.col("n2"))

    def columns(pdf: pd.DataFrame) -> pd.DataFrame:
        s, n1, n2, t2 = (int(pdf[c].iloc[0]) for c in ("s", "n1", "n2", "t2"))
        line = np.zeros(n1, dtype=complex)
        line[pdf["t"].to_numpy() // n2] = pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy()
        k1 = np.arange(n1)
        out = np.fft.fft(line) * np.exp(-2j * np.pi * ((k1 * t2) % s) / s)
        return _keyed(pdf, keys, k1=k1, t2=np.full(n1, t2), re=out.real, im=out.imag,
                      s=np.full(n1, s), n1=np.full(n1, n1))

    def lines(pdf: pd.DataFrame) -> pd.DataFrame:
        s, n1, k1 = (int(pdf[c].iloc[0]) for c in ("s", "n1", "k1"))
        n2 = s // n1
        line = np.zeros(n2, dtype=complex)
        line[pdf["t2"].to_numpy()] = pdf["re"].to_numpy() + 1j * pdf["im"].to_numpy()
        out = np.fft.fft(line)
        return _keyed(pdf, keys, k=k1 + n1 * np.arange(n2), re=out.real, im=out.imag, s=np.full(n2, s))

    between = _schema(rows, keys, ("k1", _LONG), ("t2", _LONG), ("re", _DOUBLE), ("im", _DOUBLE),
                      ("s", _LONG), ("n1", _LONG))
    after = _schema(rows, keys, ("k", _LONG), ("re", _DOUBLE), ("im", _DOUBLE), ("s", _LONG))
    step = cells.groupBy(*keys, "t2").applyInPandas(columns, between)
    return step.groupBy(*keys, "k1").applyInPandas(lines, after)


def _chirp(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As _whole for a length without fitting factors, by three transforms of length m >= 2s."""
    m = F.pow(F.lit(2.0), F.ceil(F.log2(2 * F.col("s")))).cast("long")
    n1 = F.pow(F.lit(2.0), F.floor(F.log2(m.cast("double")) / 2)).cast("long")
    turn = F.lit(math.pi) * ((F.col("t") * F.col("t")) % (2 * F.col("s"))) / F.col("s")
    # every position is needed in the chirp, also those that hold a padding zero
    sized = rows.withColumn("m", m).withColumn("n1", n1).withColumn("len", F.col("s"))
    lengths = sized.groupBy(*keys).agg(*[F.max(c).alias(c) for c in ("m", "n1", "len")])
    block = 100_000
    blocks = lengths.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("len") - 1) / block))))
    full = blocks.withColumn("t", F.explode(F.sequence(
        F.col("b") * block, F.least((F.col("b") + 1) * block, F.col("len")) - 1))).withColumn("s", F.col("len"))
    wave = full.select(*keys, "t", "n1", "m", F.cos(turn).alias("re"), F.sin(turn).alias("im"))
    mirrored = wave.where(F.col("t") > 0).withColumn("t", F.col("m") - F.col("t"))
    kernel = wave.unionByName(mirrored).withColumn("s", F.col("m")).drop("m")

    def product(a: tuple[Column, Column], b: tuple[Column, Column]) -> tuple[Column, Column]:
        return a[0] * b[0] - a[1] * b[1], a[0] * b[1] + a[1] * b[0]

    minus = (F.cos(turn), -F.sin(turn))
    signal = product((F.col("re"), F.col("im")), minus)
    turned = sized.select(*keys, "t", "n1", F.col("m").alias("s"), signal[0].alias("re"), signal[1].alias("im"))
    left = _grid(turned, keys)
    right = _grid(kernel, keys).withColumnRenamed("re", "re2").withColumnRenamed("im", "im2").drop("s")
    both = join_on(left, right, [*keys, "k"])
    spectrum = product((F.col("re"), F.col("im")), (F.col("re2"), F.col("im2")))
    # inverse transform: conjugate in, conjugate out, over m
    back = both.select(*keys, F.col("k").alias("t"), "s", spectrum[0].alias("re"), (-spectrum[1]).alias("im"))
    back = join_on(back, lengths.select(*keys, "n1", "len"), keys)
    conv = join_on(_grid(back.drop("len"), keys), lengths.select(*keys, "len"), keys)
    conv = conv.where(F.col("k") < F.col("len")).select(
        *keys, F.col("k").alias("t"), F.col("len").alias("s"),
        (F.col("re") / F.col("s")).alias("re"), (-F.col("im") / F.col("s")).alias("im"))
    out = product((F.col("re"), F.col("im")), minus)
    return conv.select(*keys, F.col("t").alias("k"), out[0].alias("re"), out[1].alias("im"), "s")


def _transform(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Discrete Fourier transform of (keys, t, x, s); positions from s on are cut off."""
    rows = rows.where(F.col("t") < F.col("s")).select(
        *keys, "t", F.col("x").alias("re"), F.lit(0.0).alias("im"), "s")
    spark = rows.sparkSession
    limit = single_task_rows(spark)
    lengths = rows.groupBy(*keys).agg(F.max("s").alias("s"))
    longest = lengths.agg(F.max("s")).first()[0] or 0
    if longest <= limit:
        return _whole(rows, keys)

    @F.pandas_udf(_LONG)
    def factor(s: pd.Series) -> pd.Series:
        return s.map(near_square_factor)

    cut = stored(lengths.withColumn("n1", factor("s")))
    rows = join_on(rows, cut.drop("s"), keys)
    # both sides of the grid must fit a task
    fits = F.col("s") / F.col("n1") <= limit
    return _grid(rows.where(fits), keys).unionByName(_chirp(rows.where(~fits).drop("n1"), keys))


def _inner_keys(keys: Sequence[str]) -> list[str]:
    """Names for the key columns that cannot meet those of the transform."""
    return [f"__key{i}" for i in range(len(keys))]


def _rows(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str], nfft: int | None) -> DataFrame:
    """(inner keys, t, x, n, s): positions from 0, series length, transform length."""
    named = [F.col(k).alias(inner) for k, inner in zip(keys, _inner_keys(keys))]
    ordering = [f"__order{i}" for i in range(len(order))]
    df = df.select(*named, *[F.col(o).alias(n) for o, n in zip(order, ordering)], F.col(value).alias("__value"))
    keys, order, value = _inner_keys(keys), ordering, "__value"
    numbered = positions(df, keys, [F.col(c) for c in order], "__p", fits_one_task(df, keys))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    s = F.lit(nfft).cast("long") if nfft is not None else F.col("n")
    return join_summary(numbered, sizes, keys).select(
        *keys, (F.col("__p") - 1).cast("long").alias("t"), finite(value).alias("x"), F.col("n").cast("long"),
        s.alias("s"))


def _outer(keys: Sequence[str], names: Sequence[str]) -> list[Column]:
    return [F.col(inner).alias(name) for inner, name in zip(keys, names)]


def fft_spectrum(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str], fs: float = 1.0,
                 nfft: int | None = None, norm: str = "backward") -> DataFrame:
    """(keys, bin, frequency, magnitude, phase) of the non-negative frequencies.

    Magnitudes are scaled by 2/s (the constant too) for norm `backward` and by
    1/s for `forward`. An even length s has s/2 bins, an odd one s//2 + 1.
    """
    scales = {"backward": F.lit(2.0) / F.col("s"), "forward": F.lit(1.0) / F.col("s")}
    if norm not in scales:
        raise ValueError(f"unknown norm: {norm}")
    names, keys = keys, _inner_keys(keys)
    rows = _rows(df, value, names, order, nfft)
    kept = F.when(F.col("s") % 2 == 0, F.floor(F.col("s") / 2)).otherwise(F.floor(F.col("s") / 2) + 1)
    out = _transform(rows, keys).where(F.col("k") < kept)
    size = F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im"))
    return out.select(
        *_outer(keys, names), F.col("k").alias("bin"), (F.col("k") * F.lit(float(fs)) / F.col("s")).alias("frequency"),
        (size * scales[norm]).alias("magnitude"), F.atan2("im", "re").alias("phase"))


# Coefficients of the periodic cosine windows, from the constant up.
COSINE_WINDOWS = {
    "boxcar": (1.0,),
    "hann": (0.5, 0.5),
    "hamming": (0.54, 0.46),
    "blackman": (0.42, 0.5, 0.08),
    "nuttall": (0.3635819, 0.4891775, 0.1365995, 0.0106411),
    "flattop": (0.21557895, 0.41663158, 0.277263158, 0.083578947, 0.006947368),
}


def _taper(window: str | Sequence[float]) -> Column:
    """The weight of place t: of a named window as long as the series, or from a list of weights."""
    if not isinstance(window, str):
        return F.get(F.lit([float(w) for w in window]), F.col("t").cast("int"))
    turn = F.lit(2 * math.pi) * F.col("t") / F.col("used")
    if window == "bartlett":
        return F.lit(1.0) - F.abs(F.lit(2.0) * F.col("t") / F.col("used") - F.lit(1.0))
    if window not in COSINE_WINDOWS:
        raise ValueError(f"unknown window: {window}")
    weight = F.lit(0.0)
    for k, a in enumerate(COSINE_WINDOWS[window]):
        weight = weight + F.lit(a if k % 2 == 0 else -a) * F.cos(F.lit(float(k)) * turn)
    return weight


def periodogram(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str], fs: float = 1.0,
                window: str | Sequence[float] = "hann", nfft: int | None = None, detrend: str | None = None,
                return_onesided: bool = True, scaling: str = "density") -> DataFrame:
    """(keys, bin, frequency, power) with a periodic window, optional removal of the mean
    (`constant`) or line (`linear`), and power per frequency or per bin (`spectrum`).

    The window is a name or a list of weights, one for each value of the series; then `nfft` is
    the number of weights, and longer series are cut to it.
    """
    if not isinstance(window, str):
        if nfft not in (None, len(window)):
            raise ValueError("give as many weights as nfft")
        nfft = len(window)
    if scaling not in ("density", "spectrum"):
        raise ValueError(f"unknown scaling: {scaling}")
    names, keys = keys, _inner_keys(keys)
    rows = _rows(df, value, names, order, nfft)
    rows = rows.withColumn("used", F.least("n", "s")).where(F.col("t") < F.col("used"))
    x, t = F.col("x"), F.col("t").cast("double")
    w = _taper(window)
    fitted = rows.groupBy(*keys).agg(
        F.avg(x).alias("mean"), F.regr_slope(x, t).alias("slope"), F.regr_intercept(x, t).alias("intercept"),
        F.sum(w).alias("w1"), F.sum(w * w).alias("w2"))
    fitted = stored(fitted)
    rows = attach(rows, fitted, list(keys)) if keys else join_on(rows, fitted, keys)
    if detrend in ("constant", "linear"):
        flat = x - F.col("mean") if detrend == "constant" else x - (F.col("intercept") + F.col("slope") * t)
    elif detrend is None:
        flat = x
    else:
        raise ValueError(f"unknown detrend: {detrend}")
    spectrum = _transform(rows.select(*keys, "t", (flat * w).alias("x"), "s"), keys)
    weights = fitted.select(*keys, "w1", "w2")
    spectrum = attach(spectrum, weights, list(keys)) if keys else join_on(spectrum, weights, keys)
    base = F.lit(float(fs)) * F.col("w2") if scaling == "density" else F.col("w1") * F.col("w1")
    power = (F.col("re") * F.col("re") + F.col("im") * F.col("im")) / base
    k, s = F.col("k"), F.col("s")
    if return_onesided:
        single = (k == 0) | (k * 2 == s)
        power = F.when(single, power).otherwise(2 * power)
        spectrum = spectrum.where(k * 2 <= s)
        signed = k
    else:
        signed = F.when(k * 2 < s, k).otherwise(k - s)
    return spectrum.select(*_outer(keys, names), k.alias("bin"), (signed * F.lit(float(fs)) / s).alias("frequency"), power.alias("power"))
