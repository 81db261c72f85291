"""Connected components of a table of edges, by alternating large-star and small-star steps.

Each step is an aggregation for the least neighbour of a node and a join of that minimum back to the edges, so no node's
neighbours ever meet in one task; large partitions of the joins are split by AQE. The edges of every step are stored in
the shared scratch folder. Steps end when the edges form stars; their number grows with the logarithm of the longest
path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import stored
from shelfspark.sources.scratch import delete_path


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: (u, v) with u > v. Large: link every larger neighbour of a node to its least one; small: every
    smaller neighbour, and the node."""
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = near.join(least, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has either one edge to a smaller node and none from a larger one, or only the latter."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    degrees = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return degrees.where(F.col("up") + F.col("down") > 1).isEmpty()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: for each node of an edge the least node it can reach. Edges with a null end, and from a
    node to itself, are ignored."""
    spark = edges.sparkSession
    now = stored(
        spark,
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    while not _is_stars(now):
        after = stored(spark, _star(_star(now, large=True), large=False), "edges")
        delete_path(spark, now.inputFiles()[0].rpartition("/")[0])
        now = after
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
