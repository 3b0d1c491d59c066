"""Connected components over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setsim.llm.common import drop_step, write_step


def components(edges: DataFrame) -> DataFrame:
    """``(node, comp)`` for every node of ``edges(a, b)``; ``comp`` is the
    smallest node reachable.

    Each round takes the smallest label among a node's neighbours, then the
    label of that label.  Both joins read written tables, so that Spark can
    split the rows of a hub; the minimum is combined before the shuffle.
    """
    both = write_step(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = write_step(both.groupBy(F.col("a").alias("node"))
                        .agg(F.min("b").alias("label"))
                        .select("node", F.least("node", "label").alias("label")), "labels")
    none = F.lit(None).cast("long")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "label", none.alias("old"))
        own = labels.select("node", "label", F.col("label").alias("old"))
        mins = write_step(near.union(own).groupBy("node").agg(F.min("label").alias("label"), F.max("old").alias("old")),
                          "labels-min")
        parent = mins.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = write_step(mins.join(parent, "label").select("node", F.col("up").alias("label"), "old"), "labels-jump")
        done = jumped.filter("label <> old").isEmpty()
        drop_step(labels, mins)
        labels = jumped
        if done:
            drop_step(both)
            return labels.select("node", F.col("label").alias("comp"))
