"""Connected components by repeated contraction, for graphs that stay in the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def components(work: Workspace, edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the least node of its component.

    Each round moves every node to the least node among itself and its neighbours and contracts the edges with it;
    an edge between a node and its image keeps them connected, so rounds go on until no edge is left. Each round is
    staged: nothing but a count of edges reaches the driver.
    """
    def normal(df: DataFrame) -> DataFrame:
        return (df.where(F.col("a") != F.col("b"))
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    left = work.stage(normal(edges.select("a", "b")), f"{name}-edges")
    labels = left.select(F.col("a").alias("node")).union(left.select("b")).distinct().withColumn(
        "label", F.col("node"))
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        moved = work.stage(both.groupBy(F.col("a").alias("u")).agg(F.least("a", F.min("b")).alias("to")),
                           f"{name}-moves")
        labels = work.stage(
            labels.join(moved, labels["label"] == moved["u"], "left")
            .select("node", F.coalesce("to", "label").alias("label")), f"{name}-labels")
        ends = (left.join(moved.select(F.col("u").alias("a"), F.col("to").alias("a2")), "a")
                .join(moved.select(F.col("u").alias("b"), F.col("to").alias("b2")), "b"))
        left = work.stage(normal(ends.select(F.col("a2").alias("a"), F.col("b2").alias("b"))), f"{name}-edges")
    return labels
