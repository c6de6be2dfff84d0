"""Distributed connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreline.session import cut_lineage

#: Edges of a round whose tables are broadcast; more are joined by sorting.
FEW = 50_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node.

    Each step hangs neighbours under a smaller one (large-star: the larger
    neighbours of every node; small-star: the smaller ones), until a round
    changes nothing.  Per node only the minimum of its neighbours is
    aggregated, so a node with many links costs no task more than others.
    Every round is checkpointed and its edges are counted: the count, not Spark's
    estimate, says whether its tables are broadcast.  No edges give no rows.
    """
    told = lambda edges: tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
    now = cut_lineage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    mark = told(now)
    while True:
        to_all = F.broadcast if mark[0] <= FEW else lambda table: table.hint("merge")  # at most twice as many rows as edges
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.where("v > u").join(to_all(least), "u").where("v <> m")
                 .select(F.col("m").alias("a"), F.col("v").alias("b")))
        # now every edge (a, b) has a < b; small-star hangs the smaller neighbours of b, and b, under the smallest
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(to_all(low), "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
                 .unionAll(low.select(F.col("m").alias("a"), "b")))
        now = cut_lineage(small.distinct())
        got = told(now)
        if got == mark:
            break
        mark = got
    return (now.select(F.col("b").alias("node"), F.col("a").alias("component"))
            .unionAll(now.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct())
