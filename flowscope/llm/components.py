"""Connected components of a link table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowscope.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected links (a, b): component is
    the smallest node reachable.

    Alternating star contraction: every node links its larger neighbours to the
    smallest node it sees, then its smaller neighbours likewise, until nothing
    changes. The edges never outgrow the input and a node's neighbours are only
    ever aggregated (min), so a hub is no hot group; rounds grow with the
    logarithm of the longest chain. Every round is a stored table. It is done when
    only stars are left.
    """
    edges = stage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .where("a < b").distinct(), "links")
    while True:
        # large star: neighbours above u, and u's least neighbour (or u)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct())
        # small star: neighbours below v all link to v's least one
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(low, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y"))
                 .where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        edges = stage(small, "links")
        # done when every node is either a centre or the leaf of one centre
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("centre"), F.lit(0).alias("leaf")).unionByName(
            edges.select(F.col("b").alias("node"), F.lit(0).alias("centre"), F.lit(1).alias("leaf")))
        if ends.groupBy("node").agg(F.max("centre").alias("c"), F.sum("leaf").alias("n")).where("c + n > 1").isEmpty():
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
