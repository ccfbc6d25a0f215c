"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txspark.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b) links, root being the component's smallest node.

    Alternates two star steps until nothing changes: every node hands its smallest neighbour
    to its larger neighbours, then to all others with itself. The rounds grow with the
    logarithm of the longest path. Smallest neighbours are aggregated map-side and joined
    back, so a node with very many links stays splittable; each round is stored.
    """
    edges = stored(_larger_first(links), "links")
    mark = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # smallest neighbours, the node itself among them, to the larger neighbours
        pulled = (
            both.join(_smallest(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = stored(_larger_first(pulled), "links")
        # each node's smaller neighbours and itself meet at the smallest of them
        small = large.join(_smallest(large), "a")
        met = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            small.select("a", F.col("m").alias("b"))
        )
        edges = stored(_larger_first(met), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).collect()[0]
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        mark = now


def _larger_first(links: DataFrame) -> DataFrame:
    return (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
