"""Connected components of a link table by alternating star contraction.

Each round points every node's larger neighbours at its smallest neighbour and
then shortens the chains, so rounds grow with the logarithm of the longest
chain.  Links and labels stay in Spark tables; the minima are staged before
they are joined, so both join sides are plain exchanges and adaptive execution
can split a hub that a third of all nodes point at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stage


def _minima(edges: DataFrame, name: str) -> DataFrame:
    return stage(edges.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")), name)


def connected_components(links: DataFrame) -> DataFrame:
    """links (a long, b long) -> node long, component long: one row per node that
    is not itself the smallest of its component.  Loops and repeated links are allowed."""
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-links")
    while not _is_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stage(both.filter("v > u").join(_minima(both, "cc-large"), "u")
                      .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-step")
        least = _minima(large, "cc-small")
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        edges = stage(small.distinct(), "cc-links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _is_stars(edges: DataFrame) -> bool:
    """No node has two links down, and no centre has a link down."""
    per_node = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    centres = edges.select(F.col("v").alias("u")).distinct().withColumn("centre", F.lit(True))
    odd = per_node.join(centres, "u", "left").filter("n > 1 or centre")
    return not odd.limit(1).count()
