"""SimHash near-duplicates by multi-index hashing.

1. Fingerprints: shingles are built and hashed by built-in functions; a Python task adds the bits of
   a batch of hashes with NumPy.
2. Equal fingerprints become one row, so a group of any number of copies costs one row from here on.
3. A fingerprint is cut into three segments. Two fingerprints at `distance` or fewer differing bits
   must agree in one segment up to that segment's radius, where the radii add up to
   distance - 2. Every fingerprint enumerates the Hamming ball of its radius in each segment (47
   probes at distance 4), fetches the table rows with that segment value by an equi-join, and the
   full distance is verified. Nothing is left out.
4. Components of the verified links, as smallest ids.

The segments have 21 or 22 bits, so a probe meets one fingerprint in two million by chance. The join
has no group that one task must hold: Spark splits its large keys. A segment value shared by k
distinct fingerprints costs k^2 comparisons; for very crowded tables give fewer, longer segments.
Texts of any length are hashed whole; an empty table gives no rows, and columns other than the id and
the text are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, words
from tidemark.llm.components import components
from tidemark.operators.attach import attach
from tidemark.session import stored

BITS = 64


def shingle_hashes(text: Column, size: int) -> Column:
    """XXH64 (seed 42) of every run of `size` words; of all words where there are fewer."""
    return F.when(F.size(text) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(text) - (size - 1))),
            lambda i: F.xxhash64(F.array_join(F.slice(text, i, size), " ")),
        )
    )


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = 4) -> DataFrame:
    """(id, fp): a bit of `fp` is 1 if it is set in over half of the text's shingle hashes.

    A text without words, or NULL, has fingerprint 0.
    """
    def bit_majority(batches):
        place = (np.uint64(1) << np.arange(BITS, dtype=np.uint64))[::-1]
        for batch in batches:
            prints = np.zeros(len(batch), dtype=np.uint64)
            for k, hashes in enumerate(batch["hashes"]):
                if len(hashes):
                    octets = np.asarray(hashes, dtype=np.int64).astype(">i8").view(np.uint8).reshape(-1, 8)
                    # Sums of at most 255 rows fit a byte, which keeps the inner loop narrow.
                    total = np.zeros(BITS, dtype=np.int64)
                    for at in range(0, len(octets), 255):
                        total += np.add.reduce(np.unpackbits(octets[at:at + 255], axis=1), axis=0, dtype=np.uint8)
                    prints[k] = place[2 * total > len(octets)].sum(dtype=np.uint64)
            yield pd.DataFrame({"id": batch["id"], "fp": prints.view(np.int64)})

    split = docs.select(F.col(f"`{id_column}`").alias("id"), words(ascii_lower(F.col(f"`{text}`"))).alias("w"))
    hashed = split.select("id", shingle_hashes(F.col("w"), size).alias("hashes"))
    kind = docs.schema[id_column].dataType.simpleString()
    return hashed.mapInPandas(bit_majority, f"id {kind}, fp bigint")


def signed(bits: int) -> int:
    """The long that has these 64 bits."""
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def segments(distance: int, count: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) per segment; the radii add up to distance - count + 1."""
    count = min(count, distance + 1)
    widths = [BITS // count + (k < BITS % count) for k in range(count)]
    spare = distance - count + 1
    radii = [spare // count + (k < spare % count) for k in reversed(range(count))]
    out, shift = [], 0
    for width, radius in zip(widths, radii):
        out.append((shift, width, radius))
        shift += width
    return out


def near_pairs(distinct: DataFrame, distance: int = 4, count: int = 3) -> DataFrame:
    """(a, b) for all rows of `distinct` (fp, id) whose fingerprints differ in 1 to `distance` bits.

    a and b are their ids; every pair is found from one of its sides at least.
    """
    def part(shift: int, width: int) -> Column:
        return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(signed((1 << width) - 1)))

    def ball(number: int, value: Column, flips: list[int]) -> Column:
        return F.transform(
            F.array(*[F.lit(signed(f)).cast("long") for f in flips]),
            lambda flip: F.struct(F.lit(number).alias("segment"), value.bitwiseXOR(flip).alias("value")),
        )

    parts = segments(distance, count)
    entries, probes = [], []
    for number, (shift, width, radius) in enumerate(parts):
        flips = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)]
        value = part(shift, width)
        entries.append(F.struct(F.lit(number).alias("segment"), value.alias("value")))
        probes.append(ball(number, value, flips))
    index = distinct.select(F.col("id").alias("b"), F.col("fp").alias("other"), F.inline(F.array(*entries)))
    asked = distinct.select(F.col("id").alias("a"), "fp", F.inline(F.concat(*probes)))
    differ = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    met = asked.join(index, ["segment", "value"]).where((F.col("fp") < F.col("other")) & (differ <= distance))
    return met.select("a", "b").distinct()


def simhash_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = 4, distance: int = 4, count: int = 3
) -> DataFrame:
    """(id, fp, component): each row's fingerprint and the smallest id reachable over links.

    Rows with equal fingerprints are linked, so are rows at `distance` or fewer differing bits.
    Repeated ids share their rows' links. A row whose id is NULL joins the rows with an equal
    fingerprint; where none of those has an id, its component is NULL and it links nothing.
    """
    prints = stored(fingerprints(docs, id_column, text, size))
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("id")))
    named = distinct.where("id IS NOT NULL")
    same = prints.where("id IS NOT NULL").groupBy("id").agg(F.min("fp").alias("fp"), F.max("fp").alias("last"))
    # An id that bears two texts links their fingerprints.
    twice = prints.join(same.where("fp <> last").select("id"), "id", "left_semi")
    repeated = twice.join(distinct.select("fp", F.col("id").alias("a")), "fp").groupBy("id").agg(
        F.min("a").alias("b"), F.collect_set("a").alias("all")
    ).select(F.explode("all").alias("a"), "b")
    links = near_pairs(named, distance, count).unionByName(repeated)
    reached = components(links, "a", "b")
    labels = distinct.join(reached.withColumnRenamed("node", "id"), "id", "left").select(
        "fp", F.coalesce("component", "id").alias("component")
    )
    large = stored(prints.groupBy("fp").count().where("count > 1").join(labels, "fp").select("fp", "component"))
    # Fingerprints with many rows come back by a checked broadcast; the rest is one row each.
    hot = attach(prints, large, ["fp"])
    single = hot.where("component IS NULL").drop("component").join(labels, "fp", "left")
    few = hot.where("component IS NOT NULL").unionByName(single)
    return few.select("id", "fp", "component")


def fingerprint_text(fp: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
