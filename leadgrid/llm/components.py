"""Connected components by alternating large-star and small-star rounds.

Edges stay a distributed table; every round is two shuffles with map-side minimums and is
written to the shared folder, so neither a hub nor a lost executor matters. Long chains
shrink fast: the number of rounds grows with the logarithm of the largest component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrid.session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the smallest node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def stars(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, b): every node but the smallest of its component, with that smallest node.

    ``edges`` holds pairs (a, b) of numbers in any direction; loops and repeats do no harm.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a <> b").distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        edges = written(_small_star(_large_star(edges)), "edges")
        # Count and order-free checksum: equal edges in two rounds mean that nothing moved.
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            return edges
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
