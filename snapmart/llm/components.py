"""Connected components by alternating large-star and small-star steps.

Each step is a minimum per node, combined before the shuffle, and a join. The minima are written
first, so that both sides of the join come from fresh exchanges and adaptive execution can split a
node with very many links. The links never leave the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.where("b > a").join(stored(least, "least", few=True), "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    least = stored(links.groupBy("a").agg(F.min("b").alias("m")), "least", few=True)
    joined = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return joined.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b); root is the least node reachable.

    Self links and repeated links are allowed; an empty table gives an empty result. The loop ends
    when a round changes nothing, after about the logarithm of the longest path.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stored(ordered.where("a <> b").distinct(), "links", few=True)
    seen = None
    while True:
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        larger = stored(_large_star(current), "links", few=True)
        current = stored(_small_star(larger), "links", few=True)
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
