"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a minimum by node and a join back to the edges (Kiveris et al., 2014): a
constant number of shuffles that never gather a component or a node's neighbours in one
place. With ``hubs`` a node of very many edges meets its minimum through a broadcast (``bounded_join``). Each round ends in a written table; the number of rounds grows with the logarithm of
the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seamark.llm.common import bounded_join, written


def star(edges: DataFrame, large: bool, hubs: bool = False) -> DataFrame:
    """Edges (a > b) after joining neighbours to the smallest of each node's neighbourhood."""
    meet = lambda rows, least: bounded_join(rows, least, "a") if hubs else rows.join(least, "a")
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        moved = meet(near, least).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = meet(edges, least).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, hubs: bool = False) -> DataFrame:
    """(a, b): every node of ``edges`` but the smallest of its component, with that smallest node."""
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return now
        seen = tuple(state)
        now = written(star(star(now, True, hubs), False, hubs), "edges")
