"""Connected components of a link table, by alternating stars.

Large-star links every larger neighbour of a node to the smallest one around
it, small-star does so for the smaller ones; repeated until nothing changes,
every component is a star around its smallest node (Kiveris et al., 2014).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tamiz.session import Scratch


def _towards_minimum(pairs: DataFrame) -> DataFrame:
    """(u, v, m): m is the smallest of u and all its neighbours v."""
    smallest = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return pairs.join(smallest, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _towards_minimum(around).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    met = _towards_minimum(edges)
    lower = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.unionByName(met.select("u", F.col("m").alias("v"))).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    # 31-bit values: their sum cannot overflow below 2^32 edges per unit of 2^31.
    value = F.xxhash64("u", "v").bitwiseAND(F.lit((1 << 31) - 1))
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(value.cast("decimal(20,0)"))).first())


def components(links: DataFrame, left: str, right: str, scratch: Scratch) -> DataFrame:
    """(node, component) for every node that has a link to another one;
    ``component`` is the smallest node that can be reached from it.

    Nodes are longs.  Every round is written to the shared folder, so the
    lineage stays short and a lost executor costs a read.  The number of rounds
    grows with the logarithm of the longest chain of links.
    """
    edges = links.select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    ).where("u <> v")
    edges = scratch.stage(edges.distinct(), "edges")
    before = _fingerprint(edges)
    while before[0]:
        edges = scratch.stage(_small_star(_large_star(edges)), "edges")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
