"""Connected components over an edge table, in DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclattice.session import drop_materialized, materialize


def connected_components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """(node, component): the smallest node that links reach. Nodes without links are absent.

    Each round takes the smallest label among a node's neighbours and then the label of that label, so paths
    shorten by half; labels are written and reread, and the rounds end when no label moves. Sums are
    combined before they are shuffled, and joins on a hub's key are left to Spark's skew handling.
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a <> b")
    both = materialize(e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges", small=True)
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels", small=True)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("c")), "b").groupBy("a").agg(F.min("c").alias("c"))
        pulled = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("component").alias("old"), F.least("component", "c").alias("component"))
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("top"))
        new = materialize(pulled.join(up, "component").select("node", "old", F.least("component", "top").alias("component")), "labels", small=True)
        moved = new.where("old <> component").limit(1).count()
        drop_materialized(labels)
        labels = new.select("node", "component")
        if not moved:
            drop_materialized(both)
            return labels
