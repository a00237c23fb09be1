"""Connected components of an undirected graph, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodlens.llm.rows import stage


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, label) of every node of links (a, b): label is the same long for all nodes of a component.

    Each round every node joins the smallest of itself and its neighbours, and edges are redrawn
    between what the nodes have become; nodes without edges left are done. Labels and edges are
    written to the shared folder each round. A hub's edges are only ever pre-aggregated or
    joined on the other end, so its size doesn't meet in one task."""
    edges = stage(spark, links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while True:
        both = edges.union(edges.select("b", "a"))
        step = stage(spark, both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("to")), "step")
        if labels is None:
            labels = step.select("node", F.col("to").alias("label"))
        else:
            moved = labels.join(step.withColumnRenamed("node", "label"), "label", "left")
            labels = stage(spark, moved.select("node", F.coalesce("to", "label").alias("label")), "labels")
        ends = edges.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        edges = stage(spark, ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels
