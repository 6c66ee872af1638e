"""Connected components by hash-min with pointer jumping, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.session import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for every node of an edge; the label is the component's smallest node.

    Each round takes the smallest label around a node and then the label of that label, so the
    rounds grow with the logarithm of a path, not with its length. Every round is a reliable
    checkpoint; only one row, the number of changes, reaches the driver. Null ends are dropped,
    loops keep their node, repeated edges change nothing, no edges give no rows.
    """
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna()
    both = cut(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
        "node", F.least("node", "low").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(
            F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node", "left").select(
            "node", "label", F.least("label", "near").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("up"))
        jumped = cut(step.join(up, "low", "left").select(
            "node", F.least("low", "up").alias("label"),
            (F.least("low", "up") != F.col("label")).alias("moved")))
        moved = jumped.filter("moved").limit(1).count()
        labels = jumped.select("node", "label")
        if not moved:
            return labels
