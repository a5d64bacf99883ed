"""Connected components of a distributed edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of `edges` (columns a, b: long); a component's name is its smallest node.

    Each round sends every node's larger neighbours to its smallest one, then its smaller
    neighbours likewise; it stops when all edges lead to a centre. Rounds grow with the logarithm of
    the longest chain. Smallest neighbours are partial aggregates, never collected lists.
    """
    now = shared.keep(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small_of = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_of, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = shared.keep(small.unionByName(small_of.withColumnRenamed("m", "b")).distinct(), "edges")
        # done when every node hangs on one centre, and no centre on another
        if now.groupBy("a").count().where("count > 1").isEmpty() and now.join(now.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            break
    named = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return named.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
