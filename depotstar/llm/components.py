"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; edges (u, v) have v < u before and after."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    large = (
        both.join(least, "u").where("v > u")
        .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
    )
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u")
    return (
        small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b); a component is named by its least node.

    Each step reduces by minimum and joins, so a node with many links is combined before the
    shuffle and split by the skew join; only two numbers a step reach the driver. Steps end when
    the edges stay the same, after about the logarithm of the longest path. Links with a NULL end
    or from a node to itself say nothing.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    before = None
    while True:
        edges = stage(edges, "stars")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now[0] == 0 or now == before:
            break
        before = now
        edges = _stars(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
