"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, table


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of `edges` (a, b).

    Each round every node takes the smallest label among its neighbours, then its label's label; labels are written to
    the shared folder, so a round survives lost executors. Rounds grow with the logarithm of the longest path in
    practice. No edges give no nodes. Only the last round's table is left behind.
    """
    both = table(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        moved = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("to"))
        up = labels.select(F.col("node").alias("to"), F.col("component").alias("up"))
        moved = table(moved.join(up, "to", "left").select("node", F.col("component").alias("old"), F.least("to", F.coalesce("up", "to")).alias("component")), "labels")
        drop(labels)
        labels = moved.select("node", "component")
        if moved.where("old <> component").isEmpty():
            drop(both)
            return labels
