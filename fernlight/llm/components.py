"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fernlight.llm.common import checkpointed


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours are tied to the least of them: all larger ones, or all smaller ones and itself."""
    sides = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = sides.groupBy("a").agg(F.min("b").alias("m"))
    # the key is written anew so that both sides are shuffled for the join, which AQE needs to split a hub
    own = least.select(F.bitwise_not("a").alias("na"), "m")
    if large:
        near = sides.where("b > a").withColumn("na", F.bitwise_not("a")).join(own, "na").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    else:
        near = sides.withColumn("na", F.bitwise_not("a")).join(own, "na").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return near.where("a > b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a, b) of longs; root is the least node of its component.

    Aggregates are partial before they shuffle and a hub's rows are joined with one row, which AQE
    splits. The edges of each star are written to the checkpoint folder: a plan of both stars would make
    the first one's join anew for each of its three uses. Every round at least keeps the components, and
    the rounds stop when none of the edges changes. Edges with a null end and edges from a node to
    itself tie nothing, and a node with no other edge has no row; repeated edges count once.
    """
    now = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    seen = None
    for _ in range(rounds):
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        now = checkpointed(_stars(checkpointed(_stars(now, large=True)), large=False))
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
