"""Connected components by alternating large and small stars, without driver state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.common import materialize


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step on edges (u, v) with u > v. The large star links each node's larger
    neighbours to its smallest neighbour, the small star its smaller ones and itself."""
    if larger:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) to (node, label), label being the smallest node reachable.

    Only nodes with a link to another node are returned. Each round is a few joins and
    partial aggregations over what is left of the edges; the number of rounds grows with
    the logarithm of a component's size. Rounds are written to the shared folder."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    seen = None
    while True:
        edges = materialize(_star(_star(edges, True), False), "star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
