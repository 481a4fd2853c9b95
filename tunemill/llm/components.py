"""Connected components of an edge table by alternating star contractions.

Each round joins every edge with the smallest neighbour of its end (a minimum
with partial aggregation), first towards larger, then towards smaller
neighbours, until the edges are stars around the smallest node of each
component. Nothing is collected per node, so a node with very many edges is
only a skewed join, which Spark splits. Each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("u").alias("mu")).agg(F.min("v").alias("m"))


def _stars_only(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, or none and only larger ones."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    per = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not per.where("down > 1 or (down = 1 and up = 1)").take(1)


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (columns ``u``, ``v``, 64-bit):
    ``root`` is the smallest node of its component."""
    e = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .distinct(), "edges")
    while not _stars_only(e):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_smallest(both).hint("merge"), F.col("u") == F.col("mu")).where("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        large = cut(large, "large-star")
        joined = large.join(_smallest(large).hint("merge"), F.col("u") == F.col("mu"))
        small = (joined.select("u", F.col("m").alias("v"))
                 .union(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))))
        e = cut(small.distinct(), "small-star")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
