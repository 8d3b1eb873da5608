"""Column builders shared by the corpus operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The six blank characters between words, as a regular expression class.
BLANKS = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text in order; none for NULL."""
    parts = F.split(F.coalesce(text, F.lit("")), BLANKS + "+")
    return F.filter(parts, lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(text, UPPER, UPPER.lower())


def without(text: Column, characters: str) -> Column:
    """The text without any of the characters."""
    return F.translate(text, characters, "")


def char_count(text: Column, characters: str) -> Column:
    """How many code points of the text are among the characters."""
    return (F.length(text) - F.length(without(text, characters))).cast("long")


def let(value: Column, body) -> Column:
    """body(value), with the value computed once however often the body mentions it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def smallest_hashes(rows: DataFrame, key: Column, count: int) -> DataFrame:
    """About `count` rows, never more, spread over all: those whose key has the smallest hashes.

    A first cut by the hash's value leaves about half as many rows again, wherever they are, so what
    the last step sorts doesn't grow with the table.
    """
    total = rows.count()
    cut = -(2**63) + min(2**64 - 1, 2**64 * 3 * count // (2 * max(1, total)))
    return rows.where(F.xxhash64(key) <= cut).orderBy(F.xxhash64(key)).limit(count)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as four byte planes, compressed: most are small."""
    import zstandard

    low = numbers.astype("<u4").view(np.uint8).reshape(-1, 4)
    return zstandard.compress(np.ascontiguousarray(low.T).tobytes(), 3)


def unpack_numbers(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()
