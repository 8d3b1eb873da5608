"""Tail probabilities for the few result rows of a test, and normal scores."""

from __future__ import annotations

import math
from statistics import NormalDist

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - front * total)
    return front * _fraction(
        lambda n: (1.0, x + 1 - a) if n == 0 else (-n * (n - a), x + 2 * n + 1 - a))


def _fraction(terms, limit: int = 100_000) -> float:
    """Continued fraction a0/(b0 + a1/(b1 + ...)) by the modified Lentz method."""
    tiny = 1e-300
    value, c, d = tiny, tiny, 0.0
    for n in range(limit):
        a, b = terms(n)
        d = 1.0 / ((b + a * d) or tiny)
        c = (b + a / c) or tiny
        step = c * d
        value *= step
        if abs(step - 1.0) < 1e-15:
            return value
    raise ArithmeticError(f"no convergence in {limit} terms")


def _stirling_rest(z: float) -> float:
    """What Stirling's formula leaves of lgamma(z), for z of at least 10."""
    return (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * z * z)) / (z * z)) / (z * z)) / z


def _log_gamma_rise(z: float, by: float) -> float:
    """lgamma(z + by) - lgamma(z), without cancellation for large z."""
    if z < 10:
        return math.lgamma(z + by) - math.lgamma(z)
    return (
        (z + by - 0.5) * math.log1p(by / z) + by * (math.log(z) - 1) + _stirling_rest(z + by) - _stirling_rest(z)
    )


def _log_power(x: float, rest: float) -> float:
    """log(x) from x or from 1 - x, whichever keeps more digits."""
    return math.log(x) if x < 0.5 else math.log1p(-rest)


def _lower_beta(a: float, b: float, x: float, rest: float) -> float:
    """Regularised incomplete beta function at x; `rest` is 1 - x, exact where x is close to 1."""
    if x <= 0 or rest <= 0:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _lower_beta(b, a, rest, x)
    small, large = min(a, b), max(a, b)
    log_front = _log_gamma_rise(large, small) - math.lgamma(small)
    front = math.exp(log_front + a * _log_power(x, rest) + b * _log_power(rest, x))

    def terms(n):
        if n == 0:
            return 1.0, 1.0
        m = n // 2
        if n % 2 == 0:
            return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0
        return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0

    return front / a * _fraction(terms)


def chi2_tail_value(statistic: float, dof: float) -> float:
    return _upper_gamma(dof / 2, statistic / 2)


def f_tail_value(statistic: float, dof1: float, dof2: float) -> float:
    both = dof2 + dof1 * statistic
    return _lower_beta(dof2 / 2, dof1 / 2, dof2 / both, dof1 * statistic / both)


def _rowwise(function, *columns: pd.Series) -> pd.Series:
    return pd.Series([
        None if any(pd.isna(v) for v in row) else function(*row) for row in zip(*columns)
    ], dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_tail(statistic: pd.Series, dof: pd.Series) -> pd.Series:
    return _rowwise(chi2_tail_value, statistic, dof)


@F.pandas_udf(T.DoubleType())
def f_tail(statistic: pd.Series, dof1: pd.Series, dof2: pd.Series) -> pd.Series:
    return _rowwise(f_tail_value, statistic, dof1, dof2)


@F.pandas_udf(T.DoubleType())
def normal_score(p: pd.Series) -> pd.Series:
    """Inverse normal distribution of probabilities strictly between 0 and 1."""
    inverse = NormalDist().inv_cdf
    return p.map(inverse, na_action="ignore").astype("float64")
