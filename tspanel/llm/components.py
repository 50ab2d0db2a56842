"""Connected components of a table of edges by alternating large-star and small-star steps.

Every step is a minimum per node (combined before the shuffle) and a join back,
so a node with many neighbours is never gathered in one place. Steps end when
every node points at the smallest of its component; that takes a number of
rounds that grows with the logarithm of the graph, whatever its shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tspanel.llm.common import Scratch


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long); a component is named by its smallest node.

    Edges to itself and repeated edges change nothing; rows with a null end are ignored.
    """
    now = scratch.keep(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v")
        small = large.join(_lowest(large), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(_lowest(large).select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = scratch.keep(small, "edges")
        state = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(now)
        now = after
        if state == before:
            break
        before = state
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(nodes.select("component").distinct().select(F.col("component").alias("node"), "component"))
