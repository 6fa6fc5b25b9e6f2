"""Comparison of a task graph with the expected one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanehouse.operators.aggregates import distinct_edges


def graph_check(
    edges: DataFrame, expected: DataFrame, tasks: DataFrame, flow: str = "downstream"
) -> DataFrame:
    """Per expected task whether its neighbours are exactly the expected ones.

    ``expected`` has (task, neighbour); a NULL neighbour says that the task has none. ``tasks`` lists
    the tasks there are. Neighbours are compared one by one and only counted per task, so a task
    may have any number of them.
    """
    present = tasks.select("task").distinct().withColumn("known", F.lit(True))
    wanted_tasks = expected.select("task").distinct().join(present, "task", "left")
    want = (
        expected.where(F.col("neighbour").isNotNull()).distinct().withColumn("_want", F.lit(1))
    )
    have = distinct_edges(edges, flow).withColumn("_have", F.lit(1))
    differences = (
        want.join(have, ["task", "neighbour"], "full_outer")
        .groupBy("task")
        .agg(
            F.count_if(F.col("_have").isNull()).alias("missing"),
            F.count_if(F.col("_want").isNull()).alias("unexpected"),
        )
    )
    known = F.coalesce(F.col("known"), F.lit(False))
    missing = F.coalesce(F.col("missing"), F.lit(0).cast("long"))
    unexpected = F.coalesce(F.col("unexpected"), F.lit(0).cast("long"))
    return wanted_tasks.join(differences, "task", "left").select(
        "task",
        known.alias("known"),
        missing.alias("missing"),
        unexpected.alias("unexpected"),
        (known & (missing == 0) & (unexpected == 0)).alias("same"),
    )
