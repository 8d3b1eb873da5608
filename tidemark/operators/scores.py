"""Scores of predictions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_column, at_least_threshold


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def mse(truth: Column | str, predicted: Column | str) -> Column:
    gap = as_column(truth).cast("double") - as_column(predicted).cast("double")
    return F.avg(gap * gap)


def rmse(truth: Column | str, predicted: Column | str) -> Column:
    return F.sqrt(mse(truth, predicted))


def rmsle(truth: Column | str, predicted: Column | str) -> Column:
    """Root mean squared difference of ln(1 + x)."""
    return rmse(F.log1p(as_column(truth).cast("double")), F.log1p(as_column(predicted).cast("double")))


def no_negatives(c: Column | str) -> Column:
    """The column, or an error for a negative value."""
    c = as_column(c)
    return F.when(c < 0, F.raise_error(F.lit("negative value in a logarithmic error")).cast("double")).otherwise(c)


def r2(truth: Column | str, predicted: Column | str) -> Column:
    truth = as_column(truth).cast("double")
    return F.lit(1.0) - F.try_divide(mse(truth, predicted), F.var_pop(truth))


def adj_r2(truth: Column | str, predicted: Column | str, p: int, n: Column | None = None) -> Column:
    n = F.count(as_column(truth)) if n is None else n
    return F.lit(1.0) - (F.lit(1.0) - r2(truth, predicted)) * F.try_divide(n - 1, n - p - 1)


def regression_scores(df: DataFrame, truth: str, predicted: str, p: int, keys: Sequence[str] = ()) -> DataFrame:
    """mse, rmse, rmsle and adjusted R2 for p predictors, over all rows or per group."""
    return df.groupBy(*keys).agg(
        mse(truth, predicted).alias("mse"), rmse(truth, predicted).alias("rmse"),
        rmsle(no_negatives(truth), no_negatives(predicted)).alias("rmsle"),
        adj_r2(truth, predicted, p).alias("adj_r2"))


def _hits(truth: str, predicted: str, t: int, p: int) -> Column:
    return F.sum(((F.col(truth) == t) & (F.col(predicted) == p)).cast("long")).cast("double")


def _counts(truth: str, predicted: str) -> tuple[Column, Column, Column, Column]:
    return tuple(_hits(truth, predicted, t, p) for t, p in ((1, 1), (0, 1), (1, 0), (0, 0)))


def accuracy(truth: str, predicted: str) -> Column:
    tp, fp, fn, tn = _counts(truth, predicted)
    return F.try_divide(tp + tn, tp + fp + fn + tn)


def precision(truth: str, predicted: str) -> Column:
    tp, fp, _, _ = _counts(truth, predicted)
    return _zero(F.try_divide(tp, tp + fp))


def recall(truth: str, predicted: str) -> Column:
    tp, _, fn, _ = _counts(truth, predicted)
    return _zero(F.try_divide(tp, tp + fn))


def f1(truth: str, predicted: str) -> Column:
    tp, fp, fn, _ = _counts(truth, predicted)
    return _zero(F.try_divide(2 * tp, 2 * tp + fp + fn))


def roc_auc(truth: str, predicted: str) -> Column:
    """Area under the curve of hard labels: the mean of both class recalls."""
    tp, fp, fn, tn = _counts(truth, predicted)
    return (F.try_divide(tp, tp + fn) + F.try_divide(tn, tn + fp)) / 2


CLASSIFICATION: dict[str, Callable[[str, str], Column]] = {
    "accuracy": accuracy, "precision": precision, "recall": recall, "f1": f1, "roc_auc": roc_auc,
}


def classification_scores(df: DataFrame, truth: str, predicted: str, keys: Sequence[str] = (),
                          scores: dict[str, Callable[[str, str], Column]] | None = None) -> DataFrame:
    """One row (per group) with a column per score; all of them come from one aggregation."""
    chosen = CLASSIFICATION if scores is None else scores
    return df.groupBy(*keys).agg(*[f(truth, predicted).alias(name) for name, f in chosen.items()])


def with_threshold(df: DataFrame, probability: str, threshold: float = 0.5, name: str = "prediction") -> DataFrame:
    return df.withColumn(name, at_least_threshold(probability, threshold))


def stacked_scores(parts: dict[str, DataFrame], name: str = "split") -> DataFrame:
    """Score rows of several splits below each other; scores one of them lacks are NULL."""
    named = [df.select(F.lit(split).alias(name), "*") for split, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def l_norm_penalty(df: DataFrame, coefficient: str, weight: float = 0.001, p: float = 1.0,
                   keys: Sequence[str] = ()) -> DataFrame:
    """weight * (sum of |coefficient|^p)^(1/p)"""
    size = F.sum(F.pow(F.abs(F.col(coefficient).cast("double")), F.lit(float(p))))
    return df.groupBy(*keys).agg((F.lit(float(weight)) * F.pow(size, F.lit(1.0 / p))).alias("penalty"))
