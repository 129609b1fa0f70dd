"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` of every node that ``links (a, b)`` names, except roots; root is the smallest node it reaches.

    Each round links every node's larger neighbours to its smallest one, then the smaller ones likewise, until only
    stars around the smallest nodes are left: a few rounds, whatever the links' order. Every round is written and read
    back. Links of a node to itself are ignored.
    """
    edges = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct(), "links"
    )
    known = _mark(edges)
    while True:
        ways = edges.select(F.col("node").alias("x"), F.col("root").alias("y")).unionByName(
            edges.select(F.col("root").alias("x"), F.col("node").alias("y"))
        )
        nearest = ways.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        # Written, so that the join deals out both sides and can split the neighbours of one node.
        large = ways.where("y > x").join(staged(nearest, "nearest"), "x").select(F.col("y").alias("node"), F.col("m").alias("root"))
        large = staged(large.distinct(), "large")
        lowest = staged(large.groupBy("node").agg(F.min("root").alias("low")), "lowest")
        small = (
            large.join(lowest, "node").where("root <> low").select(F.col("root").alias("node"), F.col("low").alias("root"))
            .unionByName(lowest.select("node", F.col("low").alias("root")))
        )
        edges = staged(small.distinct(), "stars")
        now = _mark(edges)
        if now == known:
            return edges
        known = now


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first())
