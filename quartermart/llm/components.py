"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, write_table


def _star(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the smallest of u and all its partners."""
    low = pairs.groupBy("u").agg(F.min("v").alias("low"))
    return pairs.join(low, "u").select("u", "v", F.least("u", "low").alias("low"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; component is its smallest node.

    Edges are undirected; repeated edges, self loops and null ends are allowed
    (a null end drops the edge, a self loop keeps its node). Every step is a
    group-by and an equi-join on the node, written to the shared checkpoint
    folder (only the last one's links stay), so no component is ever held by one
    task. The number of rounds grows with the logarithm of the longest path.
    """
    edges = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u is not null and v is not null")
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    links = write_table(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct(), "links")
    seen = None
    while True:
        both = links.union(links.select("v", "u"))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        small, before = _star(large), links
        links = write_table(small.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
                            .union(small.select("u", "low").where("u <> low")).distinct(), "links")
        drop_table(before)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("component"))
