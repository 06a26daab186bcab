"""Connected components of a graph of links, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node, root (the smallest node that it reaches) for every node of links (a, b: long).

    Union-find by alternating large and small stars: each round hangs the larger neighbours of every node, then the
    smaller ones, on the least neighbour. Rounds grow with the logarithm of the longest chain; each is an aggregation and
    a join on the node, written out so that no lineage grows. Least neighbours are aggregated before the shuffle, and a
    node with very many links is one row on the other side of the join, so Spark can split its links."""
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    mark = state(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = cut(small.distinct(), name)
        before, mark = mark, state(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def state(edges: DataFrame) -> tuple[int, int | None]:
    """Tells two sets of edges apart."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
