"""Connected components of an edge table, by alternating large and small stars.

Every step is an aggregate of minima and a join, so neither a long chain nor
a node with a third of all edges meets in one task; each round is written to
the shared folder.  Ends when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of the node and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.least("u", "m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them; edges lead from larger to smaller."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes in ``edges`` (a, b: long); the root is the smallest node of a component."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
    old, new = None, mark(now)
    while new[0] and new != old:
        now = stored(_small_star(_large_star(now)), "edges")
        old, new = new, mark(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
