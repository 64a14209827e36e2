"""Connected components of a graph held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelion.session import stage_table


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges`` (columns a, b): label is the smallest node reachable.

    Each round takes the smallest label next to a node and then the label of that label, so that
    the length of a path halves. A round is written before the next one begins.
    """
    both = stage_table(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stage_table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        lowered = labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        lowered = stage_table(lowered, "labels")
        if lowered.filter("label < old").isEmpty():
            return lowered.select("node", "label")
        roots = lowered.select(F.col("node").alias("root"), F.col("label").alias("above"))
        labels = stage_table(lowered.join(roots, lowered["label"] == roots["root"]).select("node", F.col("above").alias("label")), "labels")
