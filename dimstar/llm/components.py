"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimstar.session import settled


def components(edges: DataFrame) -> DataFrame:
    """From (a, b) to (node, root): the smallest node of the component, for nodes with edges.

    Every node takes the smallest label among its own and its neighbours', then the label of
    its label; edges whose ends agree drop out. Neighbourhoods are only aggregated, never
    gathered, and each round is a written table, so a node may have any number of edges.
    """
    e = settled(edges.select("a", "b").where("a <> b").distinct())
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = settled(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("root"))
    )
    while True:
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("further"))
        labels = settled(labels.join(jump, "root").select("node", F.col("further").alias("root")))
        of_a = labels.select(F.col("node").alias("a"), F.col("root").alias("x"))
        of_b = labels.select(F.col("node").alias("b"), F.col("root").alias("y"))
        open_ = settled(e.join(of_a, "a").join(of_b, "b").where("x <> y").select("x", "y").distinct())
        if open_.isEmpty():
            return labels
        ends = open_.unionByName(open_.select(F.col("y").alias("x"), F.col("x").alias("y")))
        lower = settled(ends.groupBy(F.col("x").alias("root")).agg(F.min("y").alias("low")))
        labels = settled(
            labels.join(lower, "root", "left").select("node", F.least("root", "low").alias("root"))
        )
