"""URL filter: host and path rules first, a character language-model ratio for the rest.

URLs that a rule decides are the training data: two smoothed variable-order Markov models, one of
accepted and one of rejected URLs, count runs of up to four characters. A character's probability
after a context seen n times with d different successors mixes the count there with the shorter
context's probability (Witten-Bell): (c + d * p') / (n + d). A URL's score is the difference of its
two log-likelihoods per character. The threshold is calibrated on the decided URLs: it balances the
two error rates best.

Everything is DataFrame work: counts are grouped aggregates with partial results, the score table
has one row per distinct run of four characters, and URLs are scored once per distinct host and
path through a checked join with that table.

Defined results: a NULL url or one without `://` has empty host and path, fits no rule and is
blocked, as is any empty host and path; if the rules leave one class without URLs, its model knows
nothing and the threshold is 0. Repeated rows get equal verdicts; `page_id` is only passed on.
URLs of any length are scored whole; pages with equal URLs share a score and each keep their row; an
empty table gives no rows, and columns other than the id and the URL are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower
from tidemark.operators.attach import attach
from tidemark.session import stored

ORDER = 4
START, STOP = "\x02", "\x03"
ALPHABET = 128
# Score bins of the calibration, and the largest score that has a bin of its own.
BIN, LARGEST = 0.01, 8.0


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add host (A-Z lower-cased) and path."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    found = lambda k: F.coalesce(F.regexp_extract(F.col(f"`{url}`"), pattern, k), F.lit(""))
    return pages.withColumns({"host": ascii_lower(found(1)), "path": found(2)})


def matched(rules: dict[str, str]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule, written host/path, that fits; NULL where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text in sorted(rules, key=lambda r: (len(r), r)):
        host, _, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit("/" + path))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(rules[text])).otherwise(verdict)
    return rule, verdict


def _runs(text: Column) -> Column:
    padded = F.concat(F.lit(START * (ORDER - 1)), text, F.lit(STOP))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(padded, i, F.lit(ORDER)))


def score_table(runs: DataFrame) -> DataFrame:
    """(run, ratio) from (run, n, accepted, rejected): log2 odds of the run's last character.

    `n` counts all rows, the others those of each class.
    """
    out = runs.select("run")
    classes = ("accepted", "rejected")
    p = {c: F.lit(1.0 / ALPHABET) for c in classes}
    for length in range(1, ORDER + 1):
        tail = F.substring("run", ORDER - length + 1, length)
        counts = runs.groupBy(tail.alias("tail")).agg(*[F.sum(c).alias(f"{c}_c") for c in classes])
        context = counts.groupBy(F.substring("tail", 1, length - 1).alias("context")).agg(
            *[F.sum(f"{c}_c").alias(f"{c}_n") for c in classes],
            *[F.sum((F.col(f"{c}_c") > 0).cast("long")).alias(f"{c}_d") for c in classes],
        )
        out = out.withColumns({"tail": tail, "context": F.substring("run", ORDER - length + 1, length - 1)})
        out = out.join(counts, "tail").join(context, "context")
        # One column per class and length, so that no expression grows with the order.
        out = out.withColumns({
            f"{c}_{length}": F.when(F.col(f"{c}_n") == 0, p[c]).otherwise(
                (F.col(f"{c}_c") + F.col(f"{c}_d") * p[c]) / (F.col(f"{c}_n") + F.col(f"{c}_d"))
            )
            for c in classes
        }).drop("tail", "context", *[f"{c}_{x}" for c in classes for x in "cnd"])
        p = {c: F.col(f"{c}_{length}") for c in classes}
    return out.select("run", (F.log2(p["accepted"]) - F.log2(p["rejected"])).alias("ratio"))


def threshold(scores: DataFrame) -> float:
    """The bin border with the smallest sum of both error rates, from (verdict, score, n).

    Scores are counted in at most 2 * LARGEST / BIN bins first; ties go to the border next to 0.
    """
    place = F.floor(F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.col("score"))) / BIN).cast("int")
    counted = scores.groupBy(place.alias("bin")).agg(
        *[F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(v) for v in ("allow", "block")]
    ).orderBy("bin").collect()
    allow, block = (sum(r[v] for r in counted) for v in ("allow", "block"))
    if not allow or not block:
        return 0.0
    best, lost = (1.0, 0, counted[0]["bin"]), 0
    kept = block
    for row, after in zip(counted, [*counted[1:], None]):
        lost, kept = lost + row["allow"], kept - row["block"]
        border = row["bin"] + 1 if after is None else max(row["bin"] + 1, min(0, after["bin"]))
        best = min(best, (lost / allow + kept / block, abs(border), border))
    return best[2] * BIN


def url_verdicts(pages: DataFrame, rules: dict[str, str], id_column: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row; `score` is NULL for empty URLs."""
    rule, verdict = matched(rules)
    judged = with_parts(pages.select(F.col(f"`{id_column}`").alias(id_column), F.col(f"`{url}`").alias("url")))
    judged = judged.select(id_column, "host", "path", rule.alias("rule"), verdict.alias("__ruled"))
    distinct = stored(
        judged.where("host <> '' OR path <> ''").groupBy("host", "path").agg(F.first("__ruled").alias("verdict"), F.count(F.lit(1)).alias("n"))
    )
    run_rows = distinct.select("host", "path", "verdict", "n", F.explode(_runs(F.concat("host", "path"))).alias("run"))
    counted = stored(run_rows.groupBy("run").agg(
        F.sum("n").alias("n"), *[F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(c) for v, c in (("allow", "accepted"), ("block", "rejected"))]
    ))
    table = stored(score_table(counted))
    # Runs per URL are summed where they are; only (host, path, sum) moves.
    scored = attach(run_rows, table, ["run"]).groupBy("host", "path", "verdict", "n").agg(F.avg("ratio").alias("score"))
    scores = stored(scored)
    limit = threshold(scores.where("verdict IS NOT NULL"))
    model = F.when(F.col("score") >= limit, F.lit("allow")).otherwise(F.lit("block"))
    joined = judged.join(scores.select("host", "path", "score"), ["host", "path"], "left")
    return joined.select(id_column, "host", "path", "rule", F.coalesce("__ruled", model).alias("verdict"), "score")
