"""Connected components by minimum labels and pointer jumping; every round is a few narrow joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.common import dropped, saved


def connected(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node in links (a, b), two columns of one ordered type.

    A node takes the smallest label of its neighbours, which is combined before the shuffle, and then the label of its
    label, which shortens chains to about their logarithm.
    """
    edges = saved(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = saved(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")))
    written = labels
    while True:
        near = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("low"))
        lower = saved(lower)
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("lowest"))
        following = saved(lower.join(jump, "low").select("node", F.col("lowest").alias("component"), F.col("component").alias("was")))
        moved = following.filter("component != was").limit(1).count()
        dropped(written, lower)
        written, labels = following, following.drop("was")
        if not moved:
            dropped(edges)
            labels.saved_at = written.saved_at
            return labels
