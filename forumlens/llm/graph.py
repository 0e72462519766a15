"""Connected components by alternating stars, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (v, u), v > u: hang neighbours on each node's smallest one."""
    if large:
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        hung = both.join(least, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
    else:
        least = edges.groupBy("v").agg(F.min("u").alias("m"))
        hung = edges.join(least, "v").where("u > m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        hung = hung.union(least.select("v", F.col("m").alias("u")))
    return hung.where("v > u").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every linked node; the component is its smallest node.

    Each round is written to the shared folder; rounds grow with the logarithm of
    the longest chain. Links from a node to itself and null ends count for nothing.
    """
    edges = written(links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u"))
                    .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("v") > F.col("u"))).distinct(), "edges")

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("v", "u") % (1 << 30)), F.max("v")).first()

    before = state(edges)
    while before[0]:
        edges = written(_star(_star(edges, True), False), "edges")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("v").alias("node"), F.col("u").alias("component")).union(
        edges.select(F.col("u"), F.col("u"))).distinct()
