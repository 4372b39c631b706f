"""Connected components by contraction, in tables that never leave the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gustledger.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """id and component, the smallest id of its component, of every id in ``edges`` (a, b).

    Every round points each vertex at its smallest neighbour, follows the pointers one step further
    and replaces the edges by those between the vertices pointed at. An edge has two numbers and the
    rounds grow with the logarithm of the longest path, so no task gathers a component.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    left = stage(edges.select(a.alias("a"), b.alias("b")).filter("a < b").distinct(), "edges")
    labels = None
    while left.first() is not None:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = stage(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("n")).select("v", F.least("v", "n").alias("p")), "pointers")
        further = near.select(F.col("v").alias("p"), F.col("p").alias("q"))
        points = stage(near.join(further, "p").select("v", F.col("q").alias("p")), "pointers")
        if labels is None:
            labels = points.select(F.col("v").alias("id"), F.col("p").alias("component"))
        else:
            step = points.select(F.col("v").alias("component"), F.col("p").alias("next"))
            labels = labels.join(step, "component", "left").select("id", F.coalesce("next", "component").alias("component"))
        labels = stage(labels, "labels")
        ends = points.select(F.col("v").alias("a"), F.col("p").alias("x"))
        others = points.select(F.col("v").alias("b"), F.col("p").alias("y"))
        moved = left.join(ends, "a").join(others, "b").filter("x <> y")
        left = stage(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).filter(F.lit(False))
    return labels
