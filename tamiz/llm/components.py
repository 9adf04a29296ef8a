"""Connected components by label propagation with pointer jumping, all in joins and group-bys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) in either direction → (node, label), label the smallest node reachable.

    Every round takes the least label among a node and its neighbours, then replaces each label by
    that label's own label. Rounds end when nothing changes; links stay on the executors. Rows with a
    null end are left out; repeated links and loops change nothing; no links give an empty table.
    """
    both = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        .select("e.a", "e.b").distinct()
    )
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(near, labels.node == near.a).select("node", F.least("label", "near").alias("next"), F.col("label").alias("was"))
        nearer = stored(nearer)
        jump = nearer.select(F.col("node").alias("root"), F.col("next").alias("jumped"))
        moved = stored(
            nearer.join(jump, nearer.next == jump.root, "left")
            .select("node", F.least("next", F.coalesce("jumped", "next")).alias("label"), "was")
        )
        labels = moved.select("node", "label")
        if moved.where("label <> was").isEmpty():
            return labels
