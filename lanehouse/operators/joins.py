"""Joins. No side is forced to broadcast: the planner and AQE decide by the size they see."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.session import settle


def update_tracked(target: DataFrame, source: DataFrame, key: str, tracked: str) -> DataFrame:
    """The target with its tracked column taken from the source where both are known and differ.

    A key that the source holds twice and the target holds as well fails the job, as the result
    would be undefined. Numbering the source within its key shuffles and sorts it the way the join
    needs it, so the check adds neither.
    """
    nth = F.row_number().over(Window.partitionBy(key).orderBy(key))
    repeated = F.raise_error(F.concat(F.lit(f"source repeats {key} "), F.col(key).cast("string")))
    latest = (
        source.where(F.col(key).isNotNull())
        .select(key, F.col(tracked).alias("_tracked"), nth.alias("_nth"))
        .select(key, F.when(F.col("_nth") > 1, repeated).otherwise(F.col("_tracked")).alias("_latest"))
    )
    renewed = F.when(fn.changed(F.col(tracked), F.col("_latest")), F.col("_latest")).otherwise(
        F.col(tracked)
    )
    return target.join(latest, key, "left").select(
        *(renewed.alias(c) if c == tracked else F.col(c) for c in target.columns)
    )


def anti_not_in(df: DataFrame, column: str, values: DataFrame, value: str) -> DataFrame:
    """``column NOT IN (values)`` with the SQL rule for NULL.

    One NULL among the values leaves no row; a NULL column passes only when there are no values.
    The facts about NULL are scalar subqueries, which leaves a plain anti join that can be shuffled
    and split; the null-aware join of the planner would broadcast the values whatever their number.
    """
    known = settle(values.select(F.col(value).alias("_value")).distinct(), "values")
    unknown = F.count_if(F.col("_value").isNull())
    facts = known.agg(
        F.struct((F.count(F.lit(1)) == 0).alias("none"), (unknown == 0).alias("all_known"))
    ).scalar()
    possible = df.where(facts["all_known"] & (F.col(column).isNotNull() | facts["none"]))
    return possible.join(
        known.where(F.col("_value").isNotNull()), F.col(column) == F.col("_value"), "left_anti"
    )


def with_active(
    waiting: DataFrame, active: DataFrame, on: Sequence[str] = ("queue",)
) -> DataFrame:
    """Waiting queues with their active and queued jobs, 0 where there are none."""
    return waiting.join(active, list(on), "left").withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(0).cast("long"))
            for name in active.columns
            if name not in on
        }
    )


def with_config(df: DataFrame, conf: DataFrame, on: str = "queue") -> DataFrame:
    """Rows of configured queues with their settings."""
    return df.join(conf, on)


def unknown(candidates: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Ours: candidates whose id is not known yet."""
    return candidates.join(known.select(key), key, "left_anti")


def mark_known(raw: DataFrame, registered: DataFrame, key: str, as_column: str = "known") -> DataFrame:
    """``raw`` with whether its key is among the registered ones; a NULL key is not.

    A subquery as a column: the planner makes it one existence join, which reads either side once and gives
    one row per raw record however often the key is registered.
    """
    ids = registered.where(F.col(key).isNotNull()).select(F.col(key).alias("_registered"))
    return raw.withColumn(as_column, F.coalesce(F.col(key).isin(ids), F.lit(False)))


def split_new(
    raw: DataFrame, registered: DataFrame, key: str
) -> tuple[DataFrame, DataFrame]:
    """Ours: records to register, and records that are registered already."""
    ids = registered.select(key)
    return raw.join(ids, key, "left_anti"), raw.join(ids, key, "left_semi")


def manifest_todo(remote: DataFrame, local: DataFrame, path: str = "path") -> DataFrame:
    """Ours: remote files that are missing locally or differ in size or digest."""
    have = local.select(
        path, F.col("md5").alias("_md5"), F.col("size").alias("_size"), F.lit(True).alias("_have")
    )
    same = F.col("_md5").eqNullSafe(F.col("md5")) & F.col("_size").eqNullSafe(F.col("size"))
    return (
        remote.join(have, path, "left")
        .where(F.col("_have").isNull() | ~same)
        .select(*remote.columns)
    )


def manifest_verify(expected: DataFrame, actual: DataFrame, path: str = "path") -> DataFrame:
    """Ours: every path of either side with OK, MISMATCH, MISSING or EXTRA."""
    want = expected.select(path, F.col("md5").alias("_want"), F.lit(True).alias("_expected"))
    have = actual.select(path, F.col("md5").alias("_have"), F.lit(True).alias("_actual"))
    verdict = (
        F.when(F.col("_actual").isNull(), "MISSING")
        .when(F.col("_expected").isNull(), "EXTRA")
        .when(F.col("_want").eqNullSafe(F.col("_have")), "OK")
        .otherwise("MISMATCH")
    )
    return want.join(have, path, "full_outer").select(path, verdict.alias("verdict"))


def match_ids(slides: DataFrame, projects: DataFrame, key: str) -> DataFrame:
    """Ours: every slide with its project columns and whether a project was found."""
    return slides.join(projects.withColumn("matched", F.lit(True)), key, "left").withColumn(
        "matched", F.coalesce(F.col("matched"), F.lit(False))
    )


def by_queue(key: str = "queue", **counts: DataFrame) -> DataFrame:
    """Ours: counts from several sources side by side per queue, 0 where a source has none.

    Each argument is a frame of the key and one number, named after its output column. The sources
    are stacked and summed, one shuffle with partial sums in place of a chain of outer joins.
    """
    stacked = [
        frame.select(
            key,
            *(
                (F.col(value) if other == name else F.lit(0)).cast("long").alias(other)
                for other in counts
            ),
        )
        for name, frame in counts.items()
        for value in [next(c for c in frame.columns if c != key)]
    ]
    return (
        reduce(DataFrame.unionByName, stacked)
        .groupBy(key)
        .agg(*(F.sum(name).cast("long").alias(name) for name in counts))
    )


def attach_reports(
    groups: DataFrame, reports: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Ours: every group with each of its reports, and once alone when it has none.

    Written as an inner join and the groups without reports: AQE can split a key with very many
    reports in an inner join, but not on the inner side of an outer join.
    """
    keys = list(keys)
    alone = groups.join(reports.select(*keys).distinct(), keys, "left_anti")
    return groups.join(reports, keys).unionByName(alone, allowMissingColumns=True)
