"""Connected components of links between document ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcatch.runtime import drop_stored, materialise, stored_paths


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest id reachable from each linked node.

    Every round each node takes the smallest label among its neighbours, tells it to the node its old label
    names, and then takes its label's label: whole trees are hung together, so the rounds grow with
    the logarithm of the nodes. They are written to the shared folder, and a round's tables are deleted when the
    next one has been written; only counts reach the driver.
    """
    spark = links.sparkSession
    earlier = stored_paths(spark)
    forth = links.select(F.col(a).alias("node"), F.col(b).alias("other")).filter("node <> other")
    edges = materialise(
        forth.unionByName(forth.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "edges"
    )
    labels = materialise(
        edges.groupBy("node").agg(F.min("other").alias("_least")).select(
            "node", F.least("node", "_least").alias("label")
        ), "labels",
    )
    edge_paths = {p for p in stored_paths(spark) - earlier if "/edges-" in p}
    while True:
        heard = edges.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(
            F.min("label").alias("_heard")
        )
        nearer = labels.join(heard, "node")
        told = nearer.groupBy(F.col("label").alias("node")).agg(F.min("_heard").alias("_told"))
        hung = materialise(nearer.join(told, "node", "left").select(
            "node", F.col("label").alias("_old"),
            F.least("label", "_heard", F.coalesce("_told", "label")).alias("label"),
        ), "labels")
        jump = hung.select(F.col("node").alias("label"), F.col("label").alias("_jump"))
        known = stored_paths(spark)
        moved = materialise(hung.join(jump, "label", "left").select(
            "node", "_old", F.coalesce("_jump", "label").alias("label")
        ), "labels")
        changed = moved.filter("label <> _old").limit(1).count()
        labels = moved.select("node", "label")
        drop_stored(spark, keep=earlier | edge_paths | (stored_paths(spark) - known))
        if not changed:
            drop_stored(spark, keep=earlier | (stored_paths(spark) - edge_paths))
            return labels
