"""Connected components of an undirected graph by label passing with pointer jumping, one written table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import stage, unstage
from flowlab.llm.skew import join_weighted


def connected(edges: DataFrame) -> DataFrame:
    """(id, label) for every id of edges(x, y): the smallest id of its component. Each round takes the smallest label
    among the neighbours and then the label of that label; rounds grow with the logarithm of the longest chain. Neither an id with
    very many edges nor a label that very many ids have is one task."""
    both = edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()
    both = stage(both, "edges")
    labels = stage(both.groupBy("x").agg(F.min("y").alias("m"), F.count(F.lit(1)).alias("edges")).select(F.col("x").alias("id"), F.least("x", "m").alias("label"), "edges"), "labels")
    while True:
        # every edge goes both ways, so an id is met as y as often as it has edges
        seen = join_weighted(both, labels.select(F.col("id").alias("l_y"), "label", "edges"), F.col("y") == F.col("l_y"), "edges")
        near = seen.groupBy("x").agg(F.min("label").alias("m"))
        lower = stage(labels.join(near, F.col("id") == F.col("x")).select("id", F.col("label").alias("old"), F.least("label", "m").alias("label"), "edges"), "lower")
        of = lower.groupBy(F.col("label").alias("o_label")).agg(F.count(F.lit(1)).alias("n")).join(labels.select(F.col("id").alias("l_id"), F.col("label").alias("l_label")), F.col("o_label") == F.col("l_id"))
        of = stage(of.select("o_label", "l_label", "n"), "jumps")
        new = stage(join_weighted(lower, of, F.col("label") == F.col("o_label"), "n").select("id", "old", F.least("label", "l_label").alias("label"), "edges"), "labels")
        unstage(labels, lower, of)
        labels = new.select("id", "label", "edges")
        if new.filter("old <> label").isEmpty():
            unstage(both)
            return labels.select("id", "label")
