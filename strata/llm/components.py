"""Connected components by alternating large-star and small-star steps.

Each step is one grouped minimum (with map-side combine) and one join that AQE
may split, so a node with very many neighbours is neither a group in memory nor
one task.  Edges are written after each round; the number of rounds grows with
the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect neighbours of each node ``u`` to the least of them (large: the greater ones; small: the lesser ones and ``u``)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    if large:
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = both.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the component's least node) for every node of ``edges(u, v)`` that has a neighbour."""
    spark = edges.sparkSession

    def written(df):
        path = scratch_path(spark, "components")
        df.write.parquet(path)
        return spark.read.parquet(path)

    def finished(df):
        """Stars: every node has one neighbour, and no centre has one of its own."""
        several = df.groupBy("u").count().where("count > 1")
        chained = df.select("v").distinct().join(df.select(F.col("u").alias("v")), "v", "left_semi")
        return several.isEmpty() and chained.isEmpty()

    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())
    while not finished(edges):
        edges = written(_star(_star(edges, large=True), large=False))
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
