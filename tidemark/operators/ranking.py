"""Ordered work on groups of any size.

A window over a group sorts the whole group in one task. That is right for
groups below `single_task_rows`; larger ones are split into range partitions
(Spark samples the sort keys, so the parts are even however skewed the groups
are) and the parts are tied together by a small per-part summary.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import single_task_rows, stored
from .attach import attach

PART = "__part"
POSITION = "__position"
CHUNK = "__chunk"

Keys = Sequence[str]


def largest_group(df: DataFrame, by: Keys) -> int:
    """Rows of the largest group; a count with map-side combining."""
    if not by:
        return df.count()
    return df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0


def fits_one_task(df: DataFrame, by: Keys) -> bool:
    return largest_group(df, by) <= single_task_rows(df.sparkSession)


def join_on(left: DataFrame, right: DataFrame, keys: Keys, how: str = "inner") -> DataFrame:
    """Join on equally named columns where NULL equals NULL; keeps the left keys. Without keys
    the right side is a total of one row, added as scalar subqueries."""
    if not keys:
        return left.select("*", *[right.select(c).scalar().alias(c) for c in right.columns])
    renamed = right.select(*[
        F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns
    ])
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"__r_{k}"])
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def join_summary(left: DataFrame, summary: DataFrame, keys: Keys) -> DataFrame:
    """Add a small summary, one row per key, to the rows it was made from. It is stored, so that
    its size is known and it is computed once; the rows are not shuffled on the key."""
    return attach(left, stored(summary), list(keys)) if keys else join_on(left, summary, keys)


def range_parts(df: DataFrame, by: Keys, order: Sequence[Column]) -> DataFrame:
    """Rows in even ranges of (by, order), numbered in that order by column PART.

    The range bounds are sampled, so the parts are stored: every later use has
    to see the same parts, also after an executor is lost.
    """
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(count, *[F.col(k) for k in by], *order)
    return stored(ranged.withColumn(PART, F.spark_partition_id()))


def running_sums(df: DataFrame, by: Keys, order: Sequence[Column], sums: dict[str, Column],
                 fits: bool | None = None) -> DataFrame:
    """Add running totals (current row included) per group. `order` must be total."""
    if fits is None:
        fits = fits_one_task(df, by)
    so_far = (Window.unboundedPreceding, Window.currentRow)
    if fits:
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(*so_far)
        return df.select("*", *[F.sum(c).over(w).alias(n) for n, c in sums.items()])
    parts = range_parts(df, by, order)
    totals = parts.groupBy(*by, PART).agg(*[F.sum(c).alias(f"__t_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, PART, *[
        F.coalesce(F.sum(f"__t_{n}").over(earlier), F.lit(0)).alias(f"__o_{n}") for n in sums
    ])
    inside = Window.partitionBy(*by, PART).orderBy(*order).rowsBetween(*so_far)
    placed = join_on(parts, offsets, [*by, PART])
    return placed.select(*df.columns, *[
        (F.col(f"__o_{n}") + F.sum(c).over(inside)).alias(n) for n, c in sums.items()
    ])


def positions(df: DataFrame, by: Keys, order: Sequence[Column], name: str = POSITION,
              fits: bool | None = None) -> DataFrame:
    """Number the rows of each group from 1."""
    return running_sums(df, by, order, {name: F.lit(1)}, fits)


def over_series(df: DataFrame, by: Keys, order: Sequence[Column], before: int, after: int,
                build: Callable[[DataFrame, list[str]], DataFrame], fits: bool | None = None) -> DataFrame:
    """Apply `build(df, keys)`, whose windows look at most `before` rows back and `after` rows
    ahead, to every series.

    Series that fit one task are partitioned by `by` alone. Longer ones are cut
    into chunks of consecutive rows; the rows around a cut are copied to both
    sides and each row is answered only in its own chunk.
    """
    if fits is None:
        fits = fits_one_task(df, by)
    if fits:
        return build(df, list(by))
    size = max(single_task_rows(df.sparkSession), before + after + 1)
    numbered = df if POSITION in df.columns else positions(df, by, order, POSITION, fits=False)
    row = F.col(POSITION) - 1
    own = F.floor(row / size)
    first = F.floor(F.greatest(row - after, F.lit(0)) / size)
    last = F.floor((row + before) / size)
    copies = numbered.withColumn(CHUNK, F.explode(F.sequence(first, last))).withColumn("__own", own == F.col(CHUNK))
    built = build(copies, [*by, CHUNK])
    kept = built.where("__own").drop("__own", CHUNK)
    return kept if POSITION in df.columns else kept.drop(POSITION)


def last_seen(df: DataFrame, by: Keys, order: Sequence[Column], value: Column, name: str) -> DataFrame:
    """Add the latest non-null value at or before each row of its group."""
    so_far = (Window.unboundedPreceding, Window.currentRow)
    if fits_one_task(df, by):
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(*so_far)
        return df.withColumn(name, F.last(value, ignorenulls=True).over(w))
    parts = range_parts(df.withColumn("__seen", value), by, order)
    inside = Window.partitionBy(*by, PART).orderBy(*order)
    here = parts.withColumn("__here", F.last("__seen", ignorenulls=True).over(inside.rowsBetween(*so_far)))
    sort_key = F.struct(*[F.col(c) for c in _order_names(order)])
    ends = parts.where(F.col("__seen").isNotNull()).groupBy(*by, PART).agg(
        F.max_by("__seen", sort_key).alias("__end"))
    earlier = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    every = parts.select(*by, PART).distinct()
    carried = join_on(every, ends, [*by, PART], "left").select(
        *by, PART, F.last("__end", ignorenulls=True).over(earlier).alias("__carried"))
    filled = join_on(here, carried, [*by, PART])
    return filled.select(*df.columns, F.coalesce("__here", "__carried").alias(name))


def _order_names(order: Sequence[Column | str]) -> list[str]:
    if not all(isinstance(o, str) for o in order):
        raise TypeError("give the order as column names")
    return list(order)


def lowest_by_hash(df: DataFrame, by: Keys, id_columns: Keys, seed: int, quota: Column,
                   name: str = "chosen") -> DataFrame:
    """Flag exactly `quota` rows per group, the ones that come first in a seeded random order.

    `quota` may use column `n`, the group's row count. The order is the hash of
    (id, seed). Counts per leading hash bits find the one hash range in which
    the quota runs out; only the rows of that range are ranked, so no group is
    ever sorted as a whole. What remains is one cut per group, and a filter.
    Rows of equal id stay together.
    """
    hashed = df.withColumn("__hash", F.xxhash64(*[F.col(c) for c in id_columns], F.lit(seed)))
    hashed = hashed.withColumn("__range", F.shiftright("__hash", 64 - HASH_RANGE_BITS))
    ranges = hashed.groupBy(*by, "__range").agg(F.count(F.lit(1)).alias("__in_range"))
    group = Window.partitionBy(*by)
    so_far = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bounds = (
        ranges.withColumn("n", F.sum("__in_range").over(group))
        .withColumn("__until", F.sum("__in_range").over(so_far))
        .withColumn("__quota", F.least(quota.cast("long"), F.col("n")))
        .where((F.col("__until") >= F.col("__quota")) & (F.col("__until") - F.col("__in_range") < F.col("__quota")))
        .select(*by, F.col("__range").alias("__last"), (F.col("__quota") - F.col("__until") + F.col("__in_range")).alias("__rest"))
    )
    bounds = stored(bounds)
    placed = join_summary(hashed, bounds, by)
    ranked = Window.partitionBy(*by, "__range").orderBy("__hash", *id_columns)
    last = placed.where(F.col("__range") == F.col("__last")).select(*by, "__hash", *id_columns, "__range", "__rest")
    place = F.struct("__hash", *id_columns)
    cuts = last.withColumn("__row", F.row_number().over(ranked)).where(F.col("__row") <= F.col("__rest"))
    cuts = cuts.groupBy(*by).agg(F.max(place).alias("__cut"))
    flagged = join_summary(hashed, cuts, by)
    return flagged.withColumn(name, F.coalesce(place <= F.col("__cut"), F.lit(False))).select(*df.columns, name)


# Leading hash bits counted per group: one range holds about 1/65536 of a group.
HASH_RANGE_BITS = 16
