"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, label) with the smallest node reachable over *links* (a, b), for all nodes that have a link.

    *labels* (node, label) may give what is known so far; its nodes stay in the result. Each pass takes the
    least label among a node and its neighbours, then the label's own label, so that chains halve. Minima
    are pre-aggregated before the shuffle, and only two numbers a link move, so a hub with many links
    costs no more than its links. Every pass is stored in the checkpoint folder.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .distinct())
    start = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"),
                                                              F.least("a", "b").alias("label"))
    if labels is not None:
        start = labels.unionByName(start).groupBy("node").agg(F.min("label").alias("label"))
    now = stored(start)
    while True:
        near = (both.join(now.select(F.col("node").alias("b"), "label"), "b").select(F.col("a").alias("node"), "label"))
        least = now.unionByName(near).groupBy("node").agg(F.min("label").alias("label"))
        own = now.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = stored(least.join(own, "label", "left").select("node", F.coalesce("further", "label").alias("label")))
        if after.join(now, ["node", "label"], "left_anti").isEmpty():
            return after
        now = after
