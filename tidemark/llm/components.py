"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of `links`; the component is its smallest node.

    Alternates two steps until nothing changes. Large star: each node links its larger neighbours
    to the smallest of its neighbourhood. Small star: it links its smaller neighbours to it
    likewise. A round keeps at most one row per link, the number of rounds grows with the logarithm
    of the longest path, and each round is checkpointed. The smallest neighbour is an aggregate
    with partial results, so a hub costs as many rows as it has links, in any number of tasks.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    )
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("v", "m").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        # Stars are the fixed point: no node is both a member and a centre, none has two centres.
        one = after.groupBy("u").count().where("count > 1").select("u")
        chained = after.select("u").join(after.select(F.col("v").alias("u")), "u", "left_semi")
        done = one.unionByName(chained).isEmpty()
        edges = after
        if done:
            break
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(centres)
