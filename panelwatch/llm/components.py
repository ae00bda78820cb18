"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.steps import settle


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is named by its smallest node.

    Each round points the neighbours of a node at the smallest of them, first the larger
    ones, then the smaller ones, until all edges point at the root.  Rounds grow with the
    logarithm of the largest component; minima are partial sums, so a hub is no hot task,
    and only a count and a checksum reach the driver.
    """
    edges = settle(
        links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settle(large)
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(small.unionByName(root.select("u", F.col("m").alias("v"))).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
