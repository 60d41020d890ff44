"""Connected components of a link table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """node, label (the least node of its component) for every node of edges (a, b).

    Each round every node takes its least neighbour as parent, and the parent's
    parent; nodes are then replaced by their parents. Edges vanish inside a
    component, so rounds are few for stars and about the logarithm of the
    longest path else. Every round is written as a table. Nothing is collected.
    """
    edges = materialize(edges.where("a <> b").select("a", "b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.least("a", F.min("b")).alias("parent"))
        parent = materialize(parent, "parents")
        upper = parent.select(F.col("a").alias("up"), F.col("parent").alias("top"))
        jumped = materialize(parent.join(upper, parent.parent == upper.up, "left").select("a", F.coalesce("top", "parent").alias("parent")), "parents")
        first, second = jumped.select("a", F.col("parent").alias("pa")), jumped.select(F.col("a").alias("b"), F.col("parent").alias("pb"))
        if labels is None:
            labels = jumped.select(F.col("a").alias("node"), F.col("parent").alias("label"))
        else:
            moved = labels.join(jumped, labels.label == jumped.a, "left")
            labels = materialize(moved.select("node", F.coalesce("parent", "label").alias("label")), "labels")
        edges = materialize(edges.join(first, "a").join(second, "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
