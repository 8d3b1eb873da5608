"""Join a small summary back onto the rows it was made from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a summary that are sent to every task. A summary row is a key and a few numbers.
BROADCAST_ROWS = 50_000
# Copies of each summary row where the summary is larger; a hot key spreads over as many tasks.
SALTS = 16


def attach(df: DataFrame, summary: DataFrame, keys: list[str], limit: int = BROADCAST_ROWS) -> DataFrame:
    """Left join of `summary`, one row per key, onto `df`; NULL keys meet NULL keys.

    The summary is counted first: up to `limit` rows it is broadcast and the rows stay where
    they are. Beyond, both sides are shuffled on the key and a salt, so that a key with a large
    share of the rows spreads over `SALTS` tasks. The result is the same. `summary` should be
    stored, as it is read twice.
    """
    small = summary.limit(limit + 1).count() <= limit
    right = summary.withColumnsRenamed({k: f"__key_{k}" for k in keys})
    on = [F.col(f"`{k}`").eqNullSafe(F.col(f"`__key_{k}`")) for k in keys]
    if small:
        joined = df.join(F.broadcast(right), on, "left")
    else:
        df = df.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(SALTS)).cast("int"))
        right = right.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = df.join(right, [*on, F.col("__salt") == F.col("__copy")], "left").drop("__salt", "__copy")
    return joined.drop(*[f"__key_{k}" for k in keys])
