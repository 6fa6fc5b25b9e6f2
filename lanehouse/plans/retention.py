"""Removal of aged rows, with the last run of each group kept, and clean-up of idle projects."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators.aggregates import last_per_group
from lanehouse.operators.filters import older_or_equal
from lanehouse.operators.joins import anti_not_in
from lanehouse.session import settle


@dataclass(frozen=True)
class AgedTable:
    """A table to clean. With ``keep_last`` the last run of each group stays, see ``KeepLast``."""

    table: str
    age: str
    keep_last: KeepLast | None = None


@dataclass(frozen=True)
class KeepLast:
    """Which instants stay: the last of ``age`` in ``table`` among the rows where ``only`` is false, by group.

    ``only`` names flag columns, all of which must be false and known.
    """

    table: str
    age: str
    only: tuple[str, ...] = ()
    group_by: tuple[str, ...] = ()


# The tables that are cleaned, their age column, and the run table's filter and group
RUN_TABLE = "DagRun"
RUN_AGE = "execution_date"
RUN_GROUP = ("dag_id",)
RUN_FLAG = "external_trigger"
LAST_RUNS = KeepLast(RUN_TABLE, RUN_AGE, (RUN_FLAG,), RUN_GROUP)
AGED_TABLES = (
    AgedTable("BaseJob", "latest_heartbeat"),
    AgedTable("DagRun", "execution_date", LAST_RUNS),
    AgedTable("Log", "dttm"),
    AgedTable("XCom", "execution_date"),
    AgedTable("SlaMiss", "execution_date"),
    AgedTable("TaskFail", "execution_date"),
    AgedTable("RenderedTaskInstanceFields", "execution_date"),
    AgedTable("ImportError", "timestamp"),
    AgedTable("Task", "date_done"),
    AgedTable("TaskSet", "date_done"),
)

# Ours: the stages of a project on its way out
STAGES = ("active", "candidate", "notified", "deleted")


def candidates(
    df: DataFrame, age: str, cutoff: Column, kept: DataFrame | None = None
) -> DataFrame:
    """Rows to remove: not younger than the cutoff and, if given, not at a kept instant.

    Only the instant is compared, so a row of another group that shares it stays as well.
    """
    aged = older_or_equal(df, age, cutoff)
    return aged if kept is None else anti_not_in(aged, age, kept, "last")


def survivors(
    df: DataFrame, age: str, cutoff: Column, kept: DataFrame | None = None
) -> DataFrame:
    """What remains after the candidates are removed, rows without an age included."""
    aged = F.coalesce(F.col(age) <= cutoff, F.lit(False))
    if kept is None:
        return df.where(~aged)
    instants = settle(kept.select(F.col("last").alias("_last")).distinct(), "instants")
    none_unknown = instants.agg(F.count_if(F.col("_last").isNull()) == 0).scalar()
    marked = df.join(instants, F.col(age) == F.col("_last"), "left")
    return marked.where(~(aged & F.col("_last").isNull() & none_unknown)).select(*df.columns)


def kept_instants(
    runs: DataFrame,
    age: str = RUN_AGE,
    filters: Sequence[Column] | None = None,
    group_by: Sequence[str] = RUN_GROUP,
) -> DataFrame:
    """The instant of the last run of each group."""
    if filters is None:
        filters = [fn.is_false(RUN_FLAG)]
    return last_per_group(runs, age, filters, group_by)


def delete_counts(**removed: DataFrame) -> DataFrame:
    """How many rows go, per table."""
    return reduce(
        DataFrame.unionByName,
        (
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
            for name, df in removed.items()
        ),
    )


@dataclass(frozen=True)
class Cleaning:
    """One table's part of a clean-up; each frame is made when it is asked for."""

    rows: DataFrame
    age: str
    cutoff: Column
    kept: DataFrame | None

    def candidates(self) -> DataFrame:
        return candidates(self.rows, self.age, self.cutoff, self.kept)

    def survivors(self) -> DataFrame:
        return survivors(self.rows, self.age, self.cutoff, self.kept)


def retention_cleanup(
    tables: dict[str, DataFrame],
    now: Column,
    max_age_days: int | None = None,
    specs: Sequence[AgedTable] = AGED_TABLES,
) -> dict[str, Cleaning]:
    """What goes and what stays per table; a listed table that is not there is skipped.

    The instants that a rule keeps are worked out and written once, for all tables under that rule.
    """
    cutoff = fn.cutoff(now, fn.age_or_default(F.lit(max_age_days).cast("int")))
    instants: dict[KeepLast, DataFrame] = {}
    result = {}
    for spec in specs:
        if spec.table not in tables:
            continue
        rule = spec.keep_last
        if rule is not None and rule not in instants:
            flags = [fn.is_false(flag) for flag in rule.only]
            kept = kept_instants(tables[rule.table], rule.age, flags, rule.group_by)
            instants[rule] = settle(kept.select("last").distinct(), "kept")
        result[spec.table] = Cleaning(
            tables[spec.table], spec.age, cutoff, None if rule is None else instants[rule]
        )
    return result


def project_cleanup(
    projects: DataFrame, activity: DataFrame, key: str, ts: str, cutoff: Column
) -> DataFrame:
    """Ours: move idle projects one stage on.

    A project with its last activity not after the cutoff, or with none, goes to the next stage;
    any other keeps its stage, as stages only move forward.
    """
    last = activity.groupBy(key).agg(F.max(ts).alias("last_activity"))
    idle = F.col("last_activity").isNull() | (F.col("last_activity") <= cutoff)
    moved = reduce(
        lambda case, pair: case.when(F.col("stage") == pair[0], pair[1]),
        zip(STAGES[1:], (*STAGES[2:], STAGES[-1])),
        F.when(F.col("stage") == STAGES[0], STAGES[1]),
    )
    return projects.join(last, key, "left").withColumn(
        "next_stage", F.when(idle, moved).otherwise(F.col("stage"))
    )
