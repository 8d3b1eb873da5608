"""Exact interpolated quantiles of groups of any size, by radix selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import finite
from ..session import stored
from .attach import BROADCAST_ROWS

# Bits of a double that the rounds of counting fix: first sign, exponent and twelve of the fraction,
# of which real columns use few values, then the rest.
ROUND_BITS = (24, 20, 20)
# The bits of a double's fraction, its exponent's bias and the exponent of infinity.
FRACTION_BITS, BIAS, INFINITE = 52, 1023, 2047


def with_order_key(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add a long that orders like the double `value`: the bits of its size, negated below zero.

    The exponent is the floor of the binary logarithm; where its rounding misses it by one, the
    quotient by the power of two lies outside [1, 2) and sets it right. The other steps are exact.
    NULL stays NULL; -0.0 and 0.0 are one value. The steps are columns of their own, so that none is
    computed twice.
    """
    size, guess, ratio = (F.col(c) for c in ("__size", "__guess", "__ratio"))
    # Below the smallest normal number the fraction has no leading one and the exponent is 0.
    tiny = (size * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long")
    odd = F.when(size < F.lit(2.0 ** (1 - BIAS)), tiny).otherwise(F.lit(INFINITE << FRACTION_BITS))
    # One more in the fraction's place of a leading one carries into the exponent.
    fraction = F.when(ratio >= 2.0, ratio * 0.5).when(ratio < 1.0, ratio * 2.0 - 1.0).otherwise(ratio - 1.0)
    shift = F.when(ratio < 1.0, BIAS - 1).otherwise(BIAS)
    normal = F.shiftleft((guess + shift).cast("long"), FRACTION_BITS) + (fraction * F.lit(2.0 ** FRACTION_BITS)).cast("long")
    bits = F.when((size >= F.lit(2.0 ** (1 - BIAS))) & (size < float("inf")), normal).otherwise(odd)
    v = F.col(value)
    steps = df.withColumn("__size", F.abs(v)).withColumn(
        "__guess", F.least(F.greatest(F.floor(F.log2(size)), F.lit(1 - BIAS)), F.lit(BIAS)).cast("double")
    ).withColumn("__ratio", size / F.pow(F.lit(2.0), guess)).withColumn("__bits", bits)
    return steps.withColumn(name, F.when(v < 0, -F.col("__bits")).otherwise(F.col("__bits"))).drop("__size", "__guess", "__ratio", "__bits")


def quantiles(df: DataFrame, value: Column | str, probabilities: Sequence[float], by: Sequence[str] = (),
              weight: Column | str | None = None) -> DataFrame:
    """One row per group: `by`, row count `n` and array `q`, one entry per probability.

    The result is the linear interpolation between the two nearest ranks. NULL and NaN are
    ignored; a group without values has no row. Without `by` there is one row (if there is any
    value). With `weight` a row counts that often.

    Each of three rounds counts the next bits of the values' order-preserving bits, for all rows in
    the first round and then only for those that share the leading bits of a wanted rank; the counts
    combine before they move, and the digit in which a rank falls is read from running sums over the
    digits that occur. Nothing is sorted, sampled or held; skew and size don't matter.
    """
    by, shares = list(by), F.lit([float(p) for p in probabilities]).cast("array<double>")
    amount = F.lit(1) if weight is None else (F.col(weight) if isinstance(weight, str) else weight)
    rows = df.select(*by, finite(value).alias("__v"), amount.cast("long").alias("__w")).where("__v IS NOT NULL")
    keyed = with_order_key(rows, "__v", "__key")
    wanted, few, shift = None, False, 64
    for bits in ROUND_BITS:
        shift -= bits
        digit, names = F.shiftright("__key", shift), by
        if wanted is not None:
            names = [*by, "__prefix"]
            keys = wanted.select(*names).distinct().withColumnsRenamed({k: f"__r{i}" for i, k in enumerate(names)})
            same = [F.col(k).eqNullSafe(F.col(f"__r{i}")) for i, k in enumerate(names)]
            # A join, not a filter: that would be pushed below the steps of the key and repeat them.
            prefixed = keyed.withColumn("__prefix", F.shiftright("__key", shift + bits))
            inside = prefixed.join(F.broadcast(keys) if few else keys, same, "left_semi")
            digit = digit.bitwiseAND(F.lit((1 << bits) - 1))
        counted = (keyed if wanted is None else inside).groupBy(*names, digit.alias("__digit")).agg(
            F.sum("__w").alias("__c"), F.min("__v").alias("__x"))
        group = Window.partitionBy(*names)
        until = F.sum("__c").over(group.orderBy("__digit").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        digits = counted.withColumn("__before", until - F.col("__c"))
        # Digits stand where their counts begin, ranks at their own place, after a digit that begins there.
        mark = lambda at, kind, digit, x, i, n: F.struct(
            at.cast("long").alias("__at"), F.lit(kind).alias("__kind"), digit.alias("__digit"), x.alias("__x"),
            i.cast("int").alias("__i"), n.cast("long").alias("n"))
        none, before = F.lit(None), F.col("__before")
        own = F.array(mark(before, 0, F.col("__digit"), F.col("__x"), none, none))
        if wanted is None:
            n = F.sum("__c").over(group)
            position = lambda share: (F.col("__n") - 1) * share
            wishes = F.flatten(F.transform(shares, lambda share, i: F.array(*[
                mark(rank(position(share)), 1, none.cast("long"), none.cast("double"), 2 * i + k, F.col("__n"))
                for k, rank in enumerate((F.floor, F.ceil))])))
            marks = digits.withColumn("__n", n).select(
                *by, F.inline(F.when(before == 0, F.concat(own, wishes)).otherwise(own)))
        else:
            marks = digits.select(*names, F.inline(own)).unionByName(wanted.select(
                *names, F.col("__rest").alias("__at"), F.lit(1).alias("__kind"), none.cast("long").alias("__digit"),
                none.cast("double").alias("__x"), "__i", "n"))
        so_far = group.orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        latest = lambda c: F.last(c, ignorenulls=True).over(so_far)
        start = latest(F.when(F.col("__kind") == 0, F.col("__at")))
        found = marks.select(*names, "__i", "n", "__kind", latest("__digit").alias("__digit"), latest("__x").alias("__x"),
                             (F.col("__at") - start).alias("__rest")).where("__kind = 1")
        leading = F.col("__digit") if wanted is None else F.shiftleft("__prefix", bits) + F.col("__digit")
        wanted = found.select(*by, "n", "__i", "__rest", leading.alias("__prefix"), *(["__x"] if shift == 0 else []))
        if shift:
            wanted, few = _kept(wanted)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("__i", "__x"))), lambda s: s["__x"])

    def between(share: Column, i: Column) -> Column:
        h = (F.col("n") - 1) * share
        low, high = F.get("__x", 2 * i), F.get("__x", 2 * i + 1)
        # Two equal neighbours are their own mean, also where they are infinite.
        return F.when(low == high, low).otherwise(low + (h - F.floor(h)) * (high - low))

    return wanted.groupBy(*by, "n").agg(ordered.alias("__x")).select(*by, "n", F.transform(shares, between).alias("q"))


def _kept(wanted: DataFrame) -> tuple[DataFrame, bool]:
    """The wanted ranks, computed once, and whether they are few: then they are constants, else stored."""
    few = wanted.limit(BROADCAST_ROWS + 1).toArrow()
    if few.num_rows > BROADCAST_ROWS:
        return stored(wanted), False
    return wanted.sparkSession.createDataFrame(few, wanted.schema), True


def quantile_row(df: DataFrame, value: Column | str, probabilities: Sequence[float]) -> list[Column]:
    """The quantiles of a whole column as literals: a fitted parameter, ready for pushdown."""
    row = quantiles(df, value, probabilities).select("q").first()
    return [F.lit(q).cast("double") for q in (row[0] if row else [None] * len(probabilities))]
