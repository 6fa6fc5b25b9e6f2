"""Guarded status changes, registration and intake of runs. Rules are ours unless stated."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanehouse.operators.filters import complete_runs
from lanehouse.operators.joins import mark_known
from lanehouse.session import settle


@dataclass(frozen=True)
class Transition:
    new_status: str
    no_change: tuple[str, ...]


# The status changes in use and the statuses that block them
ANALYSIS_RUNNING = Transition("RUNNING", ("RUNNING", "FAILED", "FINISHED", "UNKNOWN"))
ANALYSIS_FINISHED = Transition("FINISHED", ("SEEDED", "FAILED"))
ANALYSIS_FAILED = Transition("FAILED", ("SEEDED", "FINISHED"))
RUN_RUNNING = Transition("RUNNING", ("RUNNING",))
RUN_FINISHED = Transition("FINISHED", ("SEEDED",))


def status_transition(
    table: DataFrame, ids: DataFrame, key: str, status: str, new_status: str, no_change: Sequence[str]
) -> DataFrame:
    """Set ``new_status`` on the listed rows unless their status blocks it; ``changed`` tells which.

    A row without a status is not blocked.
    """
    listed = settle(ids.select(key).distinct(), "ids").withColumn("_listed", F.lit(True))
    blocked = F.coalesce(F.col(status).isin(list(no_change)), F.lit(False))
    changed = F.col("_listed").isNotNull() & ~blocked
    columns = [
        F.when(changed, F.lit(new_status)).otherwise(F.col(c)).alias(c) if c == status else F.col(c)
        for c in table.columns
    ]
    return table.join(listed, key, "left").select(*columns, changed.alias("changed"))


def apply_transition(
    table: DataFrame, ids: DataFrame, key: str, status: str, transition: Transition
) -> DataFrame:
    return status_transition(
        table, ids, key, status, transition.new_status, transition.no_change
    )


def register_new(raw: DataFrame, registered: DataFrame, key: str) -> DataFrame:
    """Raw records marked for registration or as duplicates, all of them synced afterwards."""
    outcome = F.when(F.col("_known"), "duplicate").otherwise("registered")
    return (
        mark_known(raw, registered, key, "_known")
        .withColumn("outcome", outcome)
        .drop("_known")
        .withColumn("synced", F.lit(True))
    )


def new_runs(source: DataFrame, known: DataFrame, run: str, path: str) -> DataFrame:
    """Runs of a file listing that are not known yet, and whether their transfer is complete.

    The listing is grouped to runs before it meets the known ones.
    """
    return complete_runs(source, run, path).join(known.select(run), run, "left_anti")


def run_intake(source: DataFrame, known: DataFrame, run: str, path: str) -> DataFrame:
    """The complete new runs; the next one to take is the first by id."""
    return new_runs(source, known, run, path).where("complete").select(run)
