"""Connected components of a table of links, by distributed star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stage


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for every id in `links` (a, b): the smallest id it is connected with.

    Every round gives each node the smallest node among itself and its neighbours, first for the
    neighbours above it and then for those below, until all links lead to the smallest of their
    component. The number of rounds grows with the logarithm of the longest path. Each round's links
    are a written table; a node of many links is summed in part before any shuffle.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while True:
        # Large star: neighbours above a node go to the smallest of its neighbourhood.
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, name)
        # Small star: a node and its neighbours below go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        same = after.exceptAll(edges).isEmpty() and edges.exceptAll(after).isEmpty()
        edges = after
        if same:
            break
    found = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
