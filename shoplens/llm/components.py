"""Connected components of an edge table, by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.config import store


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of stored ``edges`` (a, b); the component is its smallest node.

    Each round every node takes the smallest label among its neighbours
    (map-side minima, so a hub costs one row per task) and then its label's
    label; rounds grow with the logarithm of a path's length. All labels of
    a round are stored, so a lost executor re-reads files.
    """
    both = store(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                 .filter("a <> b").distinct(), "component_edges")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                   .select("node", F.least("node", "m").alias("component")), "component_labels")
    while True:
        offered = (both.join(labels.withColumnRenamed("node", "b"), "b")
                   .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("offer")))
        hooked = store(labels.join(offered, "node", "left").select(
            "node", F.least("component", "offer").alias("hook"), "component"), "component_hooks")
        jump = hooked.select(F.col("node").alias("hook"), F.col("hook").alias("next"))
        after = store(hooked.join(jump, "hook").select(
            "node", F.least("hook", "next").alias("component"), F.col("component").alias("before")), "component_labels")
        changed = not after.filter("component <> before").isEmpty()
        labels = after.select("node", "component")
        if not changed:
            return labels
