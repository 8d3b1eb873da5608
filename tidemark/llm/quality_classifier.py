"""Quality classifier: document evidence shrunk toward its site by hierarchical empirical Bayes.

1. Features of whole texts by built-in functions; from here on one narrow row per document.
2. A logistic regression on a bounded sample of labelled rows (`max_train_rows`, those with the
   smallest hash of their id; the only part that doesn't see all rows). A document's evidence is its
   log odds less the sample's prior log odds: a log-likelihood ratio.
3. Grouped aggregation over all documents gives each host and each path of a host its number of
   documents and its sum of goodness: the label where there is one, else the classifier's
   probability. The global mean and the variance between hosts, by the method of moments, give the
   strength of the prior that hosts are shrunk to, and likewise paths to their host.
4. A document's posterior log odds are its evidence plus the prior log odds of its path, computed
   without its own share. Documents with a posterior of at least `threshold` are accepted.

Statistics have one row per host and path. They are combined on the map side and come back through
a checked broadcast or a salted join, so a host with a third of all rows is no hot key.

Defined results: a NULL or empty text has zero features; NULL hosts and paths are groups of their
own; a document with several labels takes their mean, at least one half counting as good, and NULL
labels don't count; without labels of both classes the evidence is 0 and the sites decide. Repeated
rows are judged alike, and without any label all documents are accepted.
Texts of any length are measured whole; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import smallest_hashes, without, words
from tidemark.operators.attach import attach
from tidemark.session import stored

FEATURES = (
    "symbol_share", "mark_share", "pipe_share", "capital_share", "digit_share", "distinct_share", "line_copies",
    "word_length", "log_words",
)
MAX_TRAIN_ROWS = 20_000
RIDGE = 1e-3
# Bounds of the strength of a prior, in documents.
LEAST, MOST = 1.0, 10_000.0
# Log odds beyond this say no more.
CERTAIN = 30.0


def featured(docs: DataFrame, text: Column) -> DataFrame:
    """Add the feature columns."""
    body = F.coalesce(text, F.lit(""))
    step = docs.withColumns({
        "__words": words(body), "__bare": without(body, " \t\n\x0b\f\r"),
        "__lines": F.filter(F.split(body, "\n"), lambda x: x != ""),
    })
    size, n = F.greatest(F.length("__bare"), F.lit(1)), F.greatest(F.size("__words"), F.lit(1))
    share = lambda characters: F.least(F.lit(1.0), (F.length("__bare") - F.length(without(F.col("__bare"), characters))) / size)
    lines = F.greatest(F.size("__lines"), F.lit(1))
    return step.withColumns({
        "symbol_share": share("#*$%&<>@^~="), "mark_share": share("!?"), "pipe_share": share("|"),
        "capital_share": F.length(F.regexp_replace("__bare", r"\P{Lu}+", "")) / size,
        "digit_share": share("0123456789"),
        "distinct_share": F.size(F.array_distinct("__words")) / n,
        "line_copies": (F.size("__lines") - F.size(F.array_distinct("__lines"))) / lines,
        "word_length": F.least(F.lit(30.0), F.length("__bare") / n), "log_words": F.log1p(F.size("__words").cast("double")),
    }).drop("__words", "__bare", "__lines")


def fit(rows: np.ndarray, good: np.ndarray) -> dict | None:
    """Ridge logistic regression by Newton's method on standardised features; None for one class."""
    if not len(good) or good.min() == good.max():
        return None
    mean, scale = rows.mean(axis=0), rows.std(axis=0)
    scale[scale == 0] = 1.0
    x = np.column_stack([np.ones(len(rows)), (rows - mean) / scale])
    w, ridge = np.zeros(x.shape[1]), RIDGE * len(rows) * np.eye(x.shape[1])
    ridge[0, 0] = 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -CERTAIN, CERTAIN)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (good - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    share = good.mean()
    return {
        "weights": w[1:] / scale, "bias": float(w[0] - (w[1:] * mean / scale).sum()),
        "prior": float(np.log(share / (1 - share))),
    }


def _log_odds(p: Column) -> Column:
    return F.log(p) - F.log(1 - p)


def _strength(between: float | None, mean: float) -> float:
    """Documents that a beta prior is worth: its variance is mean (1 - mean) / (strength + 1)."""
    if not between or between <= 0:
        return MOST
    return float(min(MOST, max(LEAST, mean * (1 - mean) / between - 1)))


def _between(groups: DataFrame, mean: Column) -> tuple[float, float]:
    """(variance between groups, weighted mean of the variance bound) without the sampling part."""
    ratio = F.col("good") / F.col("n")
    row = groups.agg(
        F.sum(F.col("n") * ((ratio - mean) * (ratio - mean) - ratio * (1 - ratio) / F.col("n"))).alias("v"),
        F.sum("n").alias("n"), F.sum("good").alias("good"),
    ).first()
    return (row["v"] or 0.0) / (row["n"] or 1), (row["good"] or 0.0) / (row["n"] or 1)


def classify(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_column: str = "doc_id", text: str = "text",
    max_train_rows: int = MAX_TRAIN_ROWS, threshold: float = 0.5,
) -> DataFrame:
    """(id, host, path, evidence, host_prior, path_prior, quality, accepted), one row per document.

    `labels` has (id, quality); host and path are expressions over the columns of `docs`.
    """
    source = docs.select(
        F.col(f"`{id_column}`").alias("id"), host.cast("string").alias("host"), path.cast("string").alias("path"),
        F.col(f"`{text}`").alias("__text"),
    )
    narrow = featured(source, F.col("__text")).drop("__text")
    known = labels.where("quality IS NOT NULL").groupBy(F.col(f"`{id_column}`").alias("id")).agg(
        (F.avg("quality") >= 0.5).cast("double").alias("label")
    )
    rows = stored(narrow.join(known, "id", "left"))

    labelled = rows.where("label IS NOT NULL").select("id", "label", *FEATURES)
    train = smallest_hashes(labelled, F.col("id").cast("string"), max_train_rows).select("label", *FEATURES).toPandas()
    model = fit(train[list(FEATURES)].to_numpy(dtype=float), train["label"].to_numpy(dtype=float))
    if model is None:
        evidence, probability = F.lit(0.0), F.lit(0.5)
    else:
        odds = F.lit(model["bias"])
        for name, weight in zip(FEATURES, model["weights"].tolist()):
            odds = odds + F.col(name) * weight
        odds = F.greatest(F.lit(-CERTAIN), F.least(F.lit(CERTAIN), odds))
        evidence, probability = odds - model["prior"], 1 / (1 + F.exp(-odds))
    scored = rows.select("id", "host", "path", evidence.alias("evidence"), F.coalesce("label", probability).alias("good"))

    paths = stored(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good")))
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    mean = min(1 - 1e-6, max(1e-6, (total["good"] or 0.0) / (total["n"] or 1))) if total["n"] else 0.5
    host_strength = _strength(_between(hosts, F.lit(mean))[0], mean)
    inner = paths.join(hosts.select(F.col("host").alias("h"), (F.col("good") / F.col("n")).alias("m")), F.col("host").eqNullSafe(F.col("h")))
    path_strength = _strength(_between(inner, F.col("m"))[0], mean)

    sites = paths.select("host", "path", F.col("n").alias("path_n"), F.col("good").alias("path_good")).join(
        hosts.select(F.col("host").alias("h"), F.col("n").alias("host_n"), F.col("good").alias("host_good")), F.col("host").eqNullSafe(F.col("h"))
    ).drop("h")
    joined = attach(scored, stored(sites), ["host", "path"])
    # Sums without the document itself; rounding may leave a sum slightly below 0 or above its count.
    less = lambda level: (
        F.greatest(F.lit(0.0), F.least(F.col(f"{level}_n") - 1.0, F.col(f"{level}_good") - F.col("good"))), F.col(f"{level}_n") - 1
    )
    good, n = less("host")
    host_prior = (good + host_strength * mean) / (n + host_strength)
    good, n = less("path")
    path_prior = (good + path_strength * F.col("host_prior")) / (n + path_strength)
    judged = joined.withColumn("host_prior", host_prior).withColumn("path_prior", path_prior)
    bounded = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("path_prior")))
    quality = 1 / (1 + F.exp(-(F.col("evidence") + _log_odds(bounded))))
    return judged.withColumn("quality", quality).select(
        F.col("id").alias(id_column), "host", "path", "evidence", "host_prior", "path_prior", "quality",
        (F.col("quality") >= threshold).alias("accepted"),
    )
