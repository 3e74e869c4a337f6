"""Connected components by alternating large-star and small-star contraction.

Every round is a fixed number of grouped minima and joins, and ends in a written table, so neither
edges nor labels reach the driver. A node with very many edges costs no task more than others:
minima are combined before the shuffle, and the joins may be split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.llm.shared import Scratch


def _linked_to_least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): each pair with the least v of its u."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _linked_to_least(both).where("v > u")
    return near.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    near = _linked_to_least(edges)
    moved = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(near.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (two long columns) that is not its component's
    least node; the root is that least node. Null ends, loops and repeated edges have no effect;
    no edges give no rows."""
    a, b = edges.columns
    now = scratch.write(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    mark = None
    for _ in range(max_rounds):
        after = now.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if after[0] == 0 or after == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = after
        following = scratch.write(_small_star(_large_star(now)))
        scratch.drop(now)
        now = following
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
