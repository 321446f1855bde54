"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import materialize


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(neighbours: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node (the larger or the smaller ones) to its least neighbour.

    The least neighbour is aggregated and joined back, so a node with many
    neighbours is never gathered in one task.
    """
    least = neighbours.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = neighbours.join(least, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, component (its smallest node) for every node that an edge names."""
    nodes = _both(edges).select(F.col("a").alias("node")).distinct()
    current = materialize(edges.select("a", "b").where("a <> b").distinct(), "edges")
    for _ in range(max_rounds):
        wide = materialize(_star(_both(current), large=True), "edges")
        down = wide.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        after = materialize(_star(down, large=False), "edges")
        changed = after.join(current, ["a", "b"], "left_anti").isEmpty() and current.join(
            after, ["a", "b"], "left_anti"
        ).isEmpty()
        current = after
        if changed:
            break
    else:
        raise RuntimeError("components did not settle")
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.join(stars, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
