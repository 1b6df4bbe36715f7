"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum and a join on the node. The minima are written first, so the join reads two
plain shuffles and AQE splits a node that holds a large share of the links. No links reach the driver.
Steps alternate until every component is a star around its least node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierloom.llm.shared import store


def _linked_to_minimum(around: DataFrame, larger_only: bool) -> DataFrame:
    """Each neighbour ``v`` of ``u`` is linked to the least node around ``u``."""
    least = store(around.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("n"), F.least("u", "v").alias("m")), "least")
    met = around.join(least, around["u"] == least["n"])
    links = (met.where("v > u") if larger_only else met).select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not larger_only:
        links = links.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """True if every node is linked to one smaller node, which is linked to none: links are (larger, smaller)."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("n"), F.lit(1).alias("up")), F.struct(F.col("b").alias("n"), F.lit(0).alias("up")))).alias("e"))
    held = ends.select("e.*").groupBy("n").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return held.where("up > 1 or (up = 1 and least = 0)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (least node reachable) of every node that has a link.

    Repeated links, both directions and links of a node to itself are allowed; a link with a null end is
    none. Without links the result is empty.
    """
    ends = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    edges = store(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _are_stars(edges):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = store(_linked_to_minimum(both, True), "large")
        edges = store(_linked_to_minimum(large.select(F.col("a").alias("u"), F.col("b").alias("v")), False), "small")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
