"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is two shuffles of the edges and at most doubles nothing: a node's neighbours all
move to the smallest of them. The number of rounds grows with the logarithm of a component's
diameter. Edges stay distributed; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect each node's neighbours (larger ones, or the smaller ones and itself) to its smallest."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: (a long, b long). Returns (node, component), stored: the smallest node reachable, for each node with an edge."""
    spark = edges.sparkSession
    edges = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        new = stored(_star(_star(edges, True), False), "stars")
        forget(spark, edges)
        edges = new
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    out = stored(edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select(F.col("b"), F.col("b"))).distinct(), "components")
    forget(spark, edges)
    return out
