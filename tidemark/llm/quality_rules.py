"""Quality rules as a bitmask ledger.

`ledger` measures every document once and stores one bit per failed rule beside the
measurements. A policy is a named, versioned set of rules; `apply_policy` turns the stored bits
into verdicts, and `ablation` counts from the bits alone what each rule of a policy decides.
Changing a policy never reads a text again.

All work is done by built-in functions of one narrow projection: no shuffle but for the ablation,
whose partial counts per bitmask are combined before they move.

Defined results: a NULL or empty text has no words, fails the word rule and is rejected by every
policy that holds it; repeated rows are judged one by one; extra columns stay in the ledger unless
they bear one of its names, in which case the ledger's column replaces them.
Texts of any length are measured whole; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import char_count, let, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_capitals", "n_bang_words",
)


@dataclass(frozen=True)
class Rule:
    """A named test over the measurements; `fails` is an SQL condition, integers only."""

    bit: int
    name: str
    fails: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


# Bits are never given to another rule: stored ledgers stay readable.
RULES = (
    Rule(0, "few_words", "n_words < 20"),
    Rule(1, "repeated_passages", "100 * n_repeat_words > 30 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > word_chars"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 60 * n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule(5, "capitals", "2 * n_capitals > n_letters"),
    Rule(6, "exclamations", "3 * n_bang_words > n_words"),
    Rule(7, "few_letters", "2 * n_letters < word_chars"),
)
BASE = RULES[0].mask | RULES[1].mask
# Policies by version: later ones are added, earlier ones stay as they are.
POLICIES = {
    "v1": BASE,
    "v2": BASE | RULES[2].mask | RULES[3].mask | RULES[4].mask,
    "v3": sum(r.mask for r in RULES),
}


def _window_hashes(hashes: Column) -> Column:
    """One hash for each run of eight words, in order; none where there are fewer words."""
    starts = F.when(F.size(hashes) >= WINDOW, F.sequence(F.lit(0), F.size(hashes) - WINDOW)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))


def _covered(windows: Column) -> Column:
    """Words inside windows that occur twice or more.

    The windows are sorted by (hash, start); the starts of those that have an equal neighbour are
    sorted again, and each adds the words that its predecessor doesn't cover.
    """
    def twice(order: Column) -> Column:
        return F.filter(order, lambda x, k: (F.get(order, k - 1)["h"] == x["h"]) | (F.get(order, k + 1)["h"] == x["h"]))

    def total(starts: Column) -> Column:
        adds = F.transform(
            starts,
            lambda s, k: F.when(k == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), s - F.get(starts, k - 1))),
        )
        return F.aggregate(adds, F.lit(0).cast("long"), lambda a, x: a + x)

    order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(order, lambda o: F.array_sort(F.transform(twice(o), lambda x: x["i"]))), total)


def repeated_words(hashes: Column) -> Column:
    """How many words lie in an eight-word window that the text holds at least twice."""
    def count(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(_covered(windows))

    return let(let(hashes, _window_hashes), count)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements; each text is split into words once.

    The word array and its hashes get columns of their own in subsequent projections, so that no
    measurement computes them again. A filter on the results would be pushed below these
    projections and compute them once per mention: filter stored ledgers, or use `accepted`.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    bare = F.col("__bare")
    split = docs.drop(*MEASURES).withColumns({
        "__words": words(F.col(f"`{text}`")),
        "__bare": F.translate(body, " \t\n\x0b\f\r", ""),
        "__lines": lines,
    })
    counted = split.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(bare).cast("long"),
        "n_symbols": char_count(bare, SYMBOLS),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_letters": F.length(F.regexp_replace(bare, r"\P{L}+", "")).cast("long"),
        "n_capitals": F.length(F.regexp_replace(bare, r"\P{Lu}+", "")).cast("long"),
        "n_bang_words": F.size(F.filter("__words", lambda w: F.substring(w, -2, 2) == "!!")).cast("long"),
        "__hashes": F.transform("__words", lambda w: F.xxhash64(w)),
    }).drop("__words", "__bare", "__lines")
    return counted.withColumn("n_repeat_words", repeated_words(F.col("__hashes"))).drop("__hashes")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with measurements and `failed`, a bit per failed rule."""
    bits = [F.when(F.expr(r.fails), F.lit(r.mask)).otherwise(F.lit(0)).cast("long") for r in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measure(docs, text).withColumn("failed", total)


def apply_policy(book: DataFrame, version: str = "v3") -> DataFrame:
    """Add `base_failed` and `kept` under a policy to rows that hold `failed`."""
    fails = lambda mask: F.col("failed").bitwiseAND(F.lit(mask).cast("long")) != 0
    return book.withColumns({"base_failed": fails(BASE), "kept": ~fails(BASE | POLICIES[version])})


def ablation(book: DataFrame, version: str = "v3") -> DataFrame:
    """Per rule of a policy: rows it fails, rows only it rejects, and rows kept without it."""
    policy = POLICIES[version]
    masks = book.select(F.col("failed").bitwiseAND(F.lit(policy).cast("long")).alias("mask")).groupBy("mask").count()
    out = [F.sum("count").alias("__rows"), F.sum(F.when(F.col("mask") == 0, F.col("count")).otherwise(0)).alias("__kept")]
    rules = [r for r in RULES if policy & r.mask]
    for r in rules:
        out.append(F.sum(F.when(F.col("mask").bitwiseAND(F.lit(r.mask).cast("long")) != 0, F.col("count")).otherwise(0)).alias(f"f{r.bit}"))
        out.append(F.sum(F.when(F.col("mask") == r.mask, F.col("count")).otherwise(0)).alias(f"o{r.bit}"))
    one = masks.agg(*out)
    rows = F.array(*[
        F.struct(
            F.lit(r.name).alias("rule"), F.coalesce(f"f{r.bit}", F.lit(0)).alias("n_failed"),
            F.coalesce(f"o{r.bit}", F.lit(0)).alias("n_only"),
            F.coalesce(F.col("__kept") + F.col(f"o{r.bit}"), F.lit(0)).alias("n_kept_without"),
        )
        for r in rules
    ])
    return one.select(F.inline(rows))


def quality_rules(docs: DataFrame, version: str = "v3") -> DataFrame:
    """Ledger and verdicts in one."""
    return apply_policy(ledger(docs), version)


def accepted(docs: DataFrame, version: str = "v3") -> DataFrame:
    """The documents that a policy keeps, with their own columns only.

    Each row becomes a list of one row or none, which stays above the measurements in the plan.
    """
    book = quality_rules(docs.select(F.struct("*").alias("__document"), "text"), version)
    one = F.array("__document")
    return book.select(F.inline(F.when(F.col("kept"), one).otherwise(F.slice(one, 1, 0))))
