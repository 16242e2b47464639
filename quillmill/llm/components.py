"""Connected components by least labels, with joins and map-side combined minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.session import cut_lineage, maybe_broadcast


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (the least node reachable) for the nodes of edges (a, b: long, not null).

    Each round a node takes the least label of its neighbours, then its label's label
    (pointer jumping), so the rounds follow the logarithm of a component's diameter.
    A node of many edges is combined map-side; nothing is gathered in one task.
    """
    both = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct())
    labels = cut_lineage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("component")).withColumnRenamed("a", "node"))
    while True:
        known = maybe_broadcast(labels)
        near = (
            both.join(known, F.col("b") == F.col("node"))
            .groupBy("a").agg(F.min("component").alias("near"))
        )
        moved = labels.join(near, F.col("node") == F.col("a")).select("node", "component", F.least("component", "near").alias("new"))
        moved = cut_lineage(moved)
        jump = maybe_broadcast(moved.select(F.col("node").alias("at"), F.col("new").alias("further")))
        stepped = cut_lineage(
            moved.join(jump, F.col("new") == F.col("at"), "left").select(
                "node", F.least("new", F.coalesce("further", "new")).alias("component"), (F.least("new", F.coalesce("further", "new")) != F.col("component")).alias("changed")
            )
        )
        labels = stepped.select("node", "component")
        if stepped.filter("changed").isEmpty():
            return labels
