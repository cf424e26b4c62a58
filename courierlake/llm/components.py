"""Connected components of a graph held in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the component's smallest node.

    Labels start as the smallest neighbour. Every round takes the smallest label among neighbours and
    then the label's own label, which halves the way to the root, until nothing changes. Joins are
    plain, so adaptive execution splits a centre with a third of all edges over several tasks, and
    minima are formed in each map task before rows of a node meet.
    """
    both = stored(
        edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        .distinct(),
        "edges",
    )
    labels = stored(
        both.groupBy("node")
        .agg(F.min("other").alias("least"))
        .select("node", F.least("node", "least").alias("root")),
        "labels",
    )
    while True:
        near = both.join(labels, "node").groupBy(F.col("other").alias("node")).agg(F.min("root").alias("near"))
        better = stored(
            labels.join(near, "node").select("node", F.least("root", "near").alias("near"), "root"), "near"
        )
        own = better.select(F.col("node").alias("near"), F.col("near").alias("jump"))
        jumped = stored(
            better.join(own, "near").select("node", F.least("near", "jump").alias("root"), F.col("root").alias("was")),
            "labels",
        )
        labels = jumped.drop("was")
        if not jumped.where("root <> was").limit(1).count():
            return labels
