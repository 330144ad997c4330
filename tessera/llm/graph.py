"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, skew_join, stored

ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """large: each node ties its greater neighbours to its least one; else it ties itself and its smaller neighbours to it. Stored."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n")), "least")
    tied = skew_join(both, least, "a", "n")  # the centre of a large star has very many edges
    if large:
        out = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    out = stored(out.where("a <> b").distinct(), "edges")
    discard(least)
    return out


def components(edges: DataFrame) -> DataFrame:
    """node, label (the least node of its component) for each node of edges a, b (long). Rows with a null are left out; nodes on no edge with another node don't occur.

    Each round is a stored table, and the one before is deleted. It fails if ROUNDS do not settle it, which takes a number of
    rounds that grows as the logarithm of the longest path.
    """
    now = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    for _ in range(ROUNDS):
        large = _star(now, True)
        discard(now)
        now = _star(large, False)
        discard(large)
        # Settled: each node is tied to one other only, and that one to none.
        ties, nodes = now.agg(F.count("*"), F.count_distinct("a")).first()
        if ties == nodes and now.join(now.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
