"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanehouse.llm.frames import keep


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component``, its smallest connected id, for every id in the edges ``a``, ``b`` (long).

    Every round gives each node the smallest label among its neighbours and then that label's own label, so
    the number of rounds grows with the logarithm of the longest path. Labels are written after each round.
    Repeated edges and loops don't matter; no edges give no rows.
    """
    both = edges.select(F.col("a").alias("id"), F.col("b").alias("other")).union(
        edges.select(F.col("b").alias("id"), F.col("a").alias("other"))
    )
    both = keep(both.where("id != other").distinct(), "neighbours")
    labels = keep(
        both.groupBy("id").agg(F.least(F.col("id"), F.min("other")).alias("component")), "labels"
    )
    while True:
        known = labels.select(F.col("id").alias("other"), F.col("component").alias("theirs"))
        nearest = both.join(known, "other").groupBy("id").agg(F.min("theirs").alias("nearest"))
        lower = labels.join(nearest, "id").select(
            "id", F.col("component").alias("before"), F.least("component", "nearest").alias("component")
        )
        root = labels.select(F.col("id").alias("component"), F.col("component").alias("root"))
        moved = keep(
            lower.join(root, "component").select("id", "before", F.least("component", "root").alias("component")),
            "labels",
        )
        labels = moved.drop("before")
        if moved.where("component != before").isEmpty():
            return labels
