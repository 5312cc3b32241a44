"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelake.llm.common import staged


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(``id``, ``component``) for every node of an edge; the component is its smallest id.

    Every round takes the smallest label among a node and its neighbours and then that label's own label, so
    the distance to the smallest id halves; it ends when no label changes.  Labels are written to the shared folder
    each round.  A node with very many edges is met by partial aggregates and by joins whose partitions adaptive
    execution splits.
    """
    both = staged(
        edges.select(F.col(left).alias("a"), F.col(right).alias("b"))
        .union(edges.select(F.col(right).alias("a"), F.col(left).alias("b")))
        .where("a <> b"),
        "edges",
    )
    labels = staged(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("component")), "labels")
    while True:
        near = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("component").alias("near"))
        lower = (
            labels.withColumnRenamed("component", "old")
            .join(near, F.col("id") == F.col("a"))
            .select("id", "old", F.least("old", "near").alias("label"))
        )
        onward = labels.select(F.col("id").alias("label"), F.col("component").alias("onward"))
        new = staged(
            lower.join(onward, "label", "left").select("id", "old", F.least("label", F.coalesce("onward", "label")).alias("component")),
            "labels",
        )
        labels = new.select("id", "component")
        if new.where("old <> component").isEmpty():
            return labels
