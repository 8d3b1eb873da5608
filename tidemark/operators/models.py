"""Classifiers on Spark ML, scored with the shared score columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import complete, doubles
from .ordered import roc_curve
from .scores import classification_scores, stacked_scores, with_threshold


def _prepared(df: DataFrame, vector: str, label: str | None) -> DataFrame:
    out = df.withColumn("__features", array_to_vector(doubles(vector)))
    return out.withColumn("__label", F.col(label).cast("double")) if label else out


def linear_classifier(train: DataFrame, vector: str, label: str, weight: float = 0.001, l1_share: float = 0.0,
                      max_iter: int = 100) -> Model:
    """Logistic regression with an L1/L2 penalty."""
    fit = LogisticRegression(
        featuresCol="__features", labelCol="__label", regParam=weight, elasticNetParam=l1_share, maxIter=max_iter)
    return fit.fit(_prepared(train.where(complete(vector)), vector, label))


def loss_history(model: Model, df: DataFrame) -> DataFrame:
    """(epoch, loss) of the fit."""
    rows = [(i, float(loss)) for i, loss in enumerate(model.summary.objectiveHistory)]
    return df.sparkSession.createDataFrame(rows, "epoch int, loss double")


def mlp_classifier(train: DataFrame, vector: str, label: str, hidden: Sequence[int] = (16,), classes: int = 2,
                   max_iter: int = 100, seed: int = 0) -> Model:
    """Feed-forward network with sigmoid hidden layers and a softmax output."""
    train = train.where(complete(vector))
    inputs = len(train.select(doubles(vector)).first()[0])
    fit = MultilayerPerceptronClassifier(
        featuresCol="__features", labelCol="__label", layers=[inputs, *hidden, classes], maxIter=max_iter, seed=seed)
    return fit.fit(_prepared(train, vector, label))


def batch_predict(model: Model, df: DataFrame, vector: str, label: str | None = None,
                  threshold: float | None = 0.5) -> DataFrame:
    """Score a table: its columns, the probability of class 1 and the label at the threshold.
    Without a threshold the most likely class is the prediction. Both are NULL for a vector that is
    NULL or has a NULL or NaN element."""
    scored = model.transform(_prepared(df.where(complete(vector)), vector, label))
    scored = scored.withColumn("probability_1", vector_to_array("probability")[1])
    if threshold is None:
        scored = scored.withColumn("prediction", F.col("prediction").cast("int"))
    else:
        scored = with_threshold(scored.drop("prediction"), "probability_1", threshold)
    scored = scored.select(*df.columns, "probability_1", "prediction")
    return scored.unionByName(df.where(~complete(vector)), allowMissingColumns=True)


def evaluate(model: Model, parts: dict[str, DataFrame], vector: str, label: str, threshold: float = 0.5) -> DataFrame:
    """One row of scores per split."""
    return stacked_scores({
        name: classification_scores(batch_predict(model, df, vector, label, threshold), label, "prediction")
        for name, df in parts.items()
    })


def classification_report(scored: DataFrame, truth: str, probability: str,
                          threshold: float = 0.5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with hard labels, their scores, and the ROC points."""
    labelled = with_threshold(scored, probability, threshold)
    return labelled, classification_scores(labelled, truth, "prediction"), roc_curve(scored, truth, probability)
