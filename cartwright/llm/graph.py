"""Connected components of an edge list, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest id reachable from each id that occurs in ``edges`` (a, b longs).

    Alternating large-star / small-star: every round hangs the larger
    neighbours of a node on its smallest one, then the smaller ones, until all
    components are stars. The smallest neighbour is found with partial aggregation and
    joined back, so that no neighbour list is ever gathered; it is dealt by another value
    than the node for that, so that AQE can split the edges of a node that most others
    hang on. Rounds are written to the shared folder, which cuts the lineage.
    """
    edges = materialize(edges.filter("a <> b").select("a", "b").distinct(), "cc-edges")
    for _ in range(max_rounds):
        star = _star(edges, larger=True)
        star = materialize(_star(star, larger=False), "cc-round")
        changed = star.join(edges, ["a", "b"], "left_anti")
        lost = edges.join(star, ["a", "b"], "left_anti")
        done = changed.isEmpty() and lost.isEmpty()
        edges = star
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
            .unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()))


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step over undirected edges; the result has a > b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger:
        both = both.filter("b < a")
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    key = F.bitwise_not("a").alias("key")
    hung = both.withColumn("key", key).join(low.select(key, "low"), "key").drop("key")
    if larger:
        out = hung.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b")))
    return out.filter("a <> b").distinct()
