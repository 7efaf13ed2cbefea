"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import written


def _toward_least(pairs: DataFrame) -> DataFrame:
    """Each node `a` with the least of itself and its partners. One row a node: combined before the shuffle."""
    return pairs.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))


def components(edges: DataFrame) -> DataFrame:
    """Nodes of `edges` (a, b) with the least node of their component: columns node, root. Loops and repeated edges do no harm.

    Alternates two steps until nothing moves: link each node's larger partners to its least one, then its smaller ones.
    Rows never exceed the edges', and rounds grow with the logarithm of the nodes. A hub's rows meet in joins, which adaptive execution
    splits, never in one group. Rounds are cut by written tables.
    """
    pairs = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_toward_least(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        least = _toward_least(large)
        linked = large.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = linked.unionByName(least.select("a", F.col("least").alias("b"))).where("a != b").distinct()
        pairs = written(small, "edges")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
