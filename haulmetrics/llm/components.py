"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetrics.llm.shared import written


def star_forest(edges: DataFrame) -> DataFrame:
    """``child, parent`` with the least node of the component as parent of every other node.

    ``edges`` has ``child, parent`` with child > parent. A round makes the parents of a node
    children of its least parent, then hands every node its parent's least parent. Both only
    group with a minimum and join written tables, so a node with very many neighbours is
    pre-aggregated and its join split. The rounds end when neither step changes an edge.
    """
    edges = written(edges.distinct(), "edges")
    while edges.take(1):
        least = written(edges.groupBy("child").agg(F.min("parent").alias("least")), "least")
        joined = edges.join(least, "child")
        moved = joined.select(
            F.when(F.col("parent") == F.col("least"), F.col("child")).otherwise(F.col("parent")).alias("child"),
            F.col("least").alias("parent"), (F.col("parent") != F.col("least")).alias("changed"))
        small = written(moved.groupBy("child", "parent").agg(F.max("changed").alias("changed")), "small-star")
        parents = written(small.groupBy("child").agg(F.min("parent").alias("above")), "parents")
        jumped = small.join(parents.withColumnRenamed("child", "parent"), "parent", "left").select(
            "child", F.coalesce("above", "parent").alias("parent"),
            (F.col("changed") | F.col("above").isNotNull()).alias("changed"))
        large = written(jumped.groupBy("child", "parent").agg(F.max("changed").alias("changed")), "large-star")
        edges = large.select("child", "parent")
        if not large.filter("changed").take(1):
            break
    return edges
