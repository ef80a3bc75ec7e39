"""Connected components by alternating large-star and small-star, with every round checkpointed.

Links stay distributed: each round is two aggregations and two joins, and the number of rounds
grows with the logarithm of the component size. A hub with many links is aggregated before its
shuffle, and the joins that carry the minimum back to its links can be split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """pairs (u, v), v != u. large: for every u, its larger neighbours point to its minimum.
    Otherwise pairs hold v < u only, and u and its neighbours point to the minimum."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = pairs.join(low, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node of its component."""
    pairs = checkpointed(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    before = None
    for _ in range(max_rounds):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        pairs = checkpointed(_star(_star(both, large=True), large=False))
        state = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("the components did not settle")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
