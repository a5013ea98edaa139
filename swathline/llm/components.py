"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is an aggregation with map-side combining and one join, so a node with very many links costs no task more
than its share (adaptive execution splits the join).  Only two numbers a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import checkpointed

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for each node of ``edges(a, b)``: ``label`` is the least node it can reach.

    Self-links and repeated links are ignored, as are links with a null end; an empty table gives an empty one.
    """
    edges = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    for _ in range(MAX_ROUNDS):
        edges = checkpointed(_small_star(_large_star(edges)).distinct())
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
