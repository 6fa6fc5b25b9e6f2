"""Job records of a cluster, the workers to start and stop, and the rows to submit."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators.aggregates import ACTIVE_STATES, QUEUED_STATE
from lanehouse.operators.filters import keep_any, keep_prefix
from lanehouse.operators.joins import with_config
from lanehouse.operators.sets import append_when, expand_by_count
from lanehouse.operators.windows import carry_forward
from lanehouse.session import settle

# Fixed values
MAX_WORKERS_PER_QUEUE = 10
MAX_TOTAL_WORKERS = 70
JOB_ID_LINE = "Job Id"
JOB_NAME_LINE = "Job_Name"
JOB_STATE_LINE = "job_state"
VALUE_FIELD = 3
QUEUE_PREFIX = "hpc"
CLEANUP_BRANCH = "cleanup_celery_workers"
BASE_QUEUE = "generic"
ARRAY_MODE = "ARRAY"

REQUESTS = "array<struct<queue: string, new_tasks: bigint>>"
STEPS = "array<struct<queue: string, total: bigint>>"


def job_records(
    lines: DataFrame,
    group: Sequence[str],
    order: str = "pos",
    text: str = QUEUE_PREFIX,
    span: int | None = 1 << 20,
) -> DataFrame:
    """One record per state line of a job report, with the id and name last seen above it.

    Only the three kinds of lines are kept, and of those only the value, before anything is
    shuffled. A record counts when any of its fields contains ``text``.
    """
    value = F.col("_value")
    kept = (
        keep_any(lines, "line", [JOB_ID_LINE, JOB_NAME_LINE, JOB_STATE_LINE])
        .withColumn("_value", fn.field("line", VALUE_FIELD))
        .select(
            *group,
            order,
            F.when(F.col("line").startswith(JOB_ID_LINE), value).alias("job_id"),
            F.when(F.col("line").contains(JOB_NAME_LINE), value).alias("job_name"),
            F.when(F.col("line").contains(JOB_STATE_LINE), value).alias("job_state"),
        )
    )
    states = F.col("job_state").isNotNull()
    filled = carry_forward(kept, group, order, ["job_id", "job_name"], span, keep=states)
    record = [F.coalesce(c, F.lit("")).alias(c) for c in ("job_id", "job_name")]
    return (
        filled.select(*group, order, *record, "job_state")
        .where(fn.row_contains(["job_id", "job_name", "job_state"], text))
    )


def queue_states(waiting: DataFrame, active: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per queue that waits or is busy: waiting (NULL if it does not), active and queued.

    The two inputs are stacked and summed together, one shuffle in place of a join.
    """
    none = F.lit(0).cast("long")
    asks = waiting.select(
        *on, F.col("waiting").cast("long").alias("waiting"), none.alias("active"), none.alias("queued")
    )
    state = F.col("state")
    jobs = F.col("n").cast("long")
    busy = active.where(state.isin(ACTIVE_STATES)).select(
        *on,
        F.lit(None).cast("long").alias("waiting"),
        jobs.alias("active"),
        F.when(state == QUEUED_STATE, jobs).otherwise(none).alias("queued"),
    )
    return (
        asks.unionByName(busy)
        .groupBy(*on)
        .agg(*(F.sum(c).alias(c) for c in ("waiting", "active", "queued")))
    )


def requests(states: DataFrame, on: Sequence[str], per_queue_cap: int) -> DataFrame:
    """The workers each waiting queue without queued jobs asks for, and whether they add to the total."""
    capped = fn.capped("waiting", per_queue_cap).cast("long")
    beyond = (F.col("active") > 0) & (capped > F.col("active"))
    return states.where(F.col("waiting").isNotNull() & (F.col("queued") < 1)).select(
        *on,
        F.when(beyond, capped - F.col("active")).otherwise(capped).alias("new_tasks"),
        ((F.col("active") > 0) & (capped > 0)).alias("_adds"),
    )


def total_steps(
    states: DataFrame, asked: DataFrame, cluster: Sequence[str], queue: str, total_cap: int
) -> DataFrame:
    """Per cluster the total to begin with, and the queues that raise it with the total after each.

    A request of w workers can be admitted only among the first ``total_cap / w`` of its size: either
    those fill the cap, or one of them was refused, after which the total never falls again. So the
    list that is folded is bounded, whatever the number of queues.
    """
    base = states.groupBy(*cluster).agg(F.sum("active").cast("long").alias("_base"))
    of_size = Window.partitionBy(*cluster, "new_tasks").orderBy(queue)
    request = F.struct(F.col(queue).alias("queue"), "new_tasks")
    adding = (
        asked.where(F.col("_adds"))
        .withColumn("_nth", F.row_number().over(of_size))
        .where(F.col("_nth") <= total_cap)
        .where((F.col("_nth") - 1) * F.col("new_tasks") < total_cap)
        .groupBy(*cluster)
        .agg(F.sort_array(F.collect_list(request)).alias("_adding"))
    )
    start = F.struct(F.col("_base").alias("total"), F.array().cast(STEPS).alias("steps"))

    def step(state: Column, entry: Column) -> Column:
        total = state["total"] + entry["new_tasks"]
        taken = F.array(F.struct(entry["queue"].alias("queue"), total.alias("total")))
        raised = F.struct(total.alias("total"), F.concat(state["steps"], taken).alias("steps"))
        return F.when(total < total_cap, raised).otherwise(state)

    in_order = F.coalesce("_adding", F.array().cast(REQUESTS))
    steps = F.aggregate(in_order, start, step, lambda state: state["steps"])
    return base.join(adding, cluster, "left").select(*cluster, "_base", steps.alias("_steps"))


def capacity_plan(
    waiting: DataFrame,
    active: DataFrame,
    cluster: Sequence[str] = ("cluster",),
    queue: str = "queue",
    per_queue_cap: int = MAX_WORKERS_PER_QUEUE,
    total_cap: int = MAX_TOTAL_WORKERS,
) -> DataFrame:
    """New workers per queue of each cluster, queues admitted in the order of their names.

    ``waiting`` has one row per queue, ``active`` rows of (queue, state, n). A queue with a queued
    job gets none. A queue without jobs asks for its waiting number, a queue with running jobs for
    what waits beyond them; a request is admitted while the total stays below the cap, and only
    requests of queues with running jobs add to the total.

    The steps of the total are worked out per cluster, then every queue is decided on its own
    against them. What is known per queue is written once, as several parts of the plan read it and
    the inputs may be costly to derive.
    """
    cluster = list(cluster)
    on = [*cluster, queue]
    states = settle(queue_states(waiting, active, on), "queues")
    asked = requests(states, on, per_queue_cap)
    steps = settle(total_steps(states, asked, cluster, queue, total_cap), "clusters")

    here, size = F.col(queue), F.col("new_tasks")
    before = F.col("_base") + size < total_cap
    is_step = F.exists("_steps", lambda s: s["queue"] == here)
    full = F.exists("_steps", lambda s: (s["queue"] < here) & (s["total"] + size >= total_cap))
    admitted = F.when(F.col("_adds"), is_step).otherwise(before & ~full)
    return asked.join(steps, cluster).where(admitted).select(*on, "new_tasks")


def idle_workers(
    workers: DataFrame, needed: DataFrame, base_queue: str = BASE_QUEUE
) -> DataFrame:
    """Ids of workers without jobs that serve neither the base queue nor a needed one.

    ``workers`` has ``worker_id``, ``active_jobs`` and the array ``queues``; ``needed`` has
    ``queue``. The queues a worker serves meet the needed ones row by row, so there may be any
    number of either, and the workers are read once.
    """
    free = workers.where((F.col("active_jobs") == 0) & ~fn.contains("queues", F.lit(base_queue)))
    wanted = settle(needed.select("queue").distinct(), "needed").withColumn("_wanted", F.lit(True))
    return (
        free.select("worker_id", F.explode_outer("queues").alias("queue"))
        .join(wanted, "queue", "left")
        .groupBy("worker_id")
        .agg(F.count("_wanted").alias("_wanted"))
        .where(F.col("_wanted") == 0)
        .select("worker_id")
    )


class Cleanup(NamedTuple):
    """``idle``: workers to stop, ``branches``: what to follow, ``plan``: workers to start, with settings."""

    idle: DataFrame
    branches: DataFrame
    plan: DataFrame


def worker_cleanup(
    workers: DataFrame,
    waiting: DataFrame,
    active: DataFrame,
    conf: DataFrame,
    cluster: Sequence[str] = ("cluster",),
    base_queue: str = BASE_QUEUE,
    per_queue_cap: int = MAX_WORKERS_PER_QUEUE,
    total_cap: int = MAX_TOTAL_WORKERS,
) -> Cleanup:
    """The capacity plan and, from it, the idle workers and the branches to follow.

    Needed are the planned queues whose name has the prefix; each is a branch, and the clean-up is one
    more when a worker is idle. Plan rows are kept for configured queues only.
    """
    capped = capacity_plan(
        waiting, active, cluster, per_queue_cap=per_queue_cap, total_cap=total_cap
    )
    plan = settle(capped, "plan")
    needed = keep_prefix(plan, "queue", QUEUE_PREFIX).select("queue").distinct()
    idle = idle_workers(workers, needed, base_queue)
    branches = append_when(
        needed.withColumnRenamed("queue", "branch"), {"branch": F.lit(CLEANUP_BRANCH)}, idle
    )
    return Cleanup(idle, branches, with_config(plan, conf))


def task_expansion(plan: DataFrame, conf: DataFrame, mode: str = "") -> DataFrame:
    """One row per submission for planned queues with settings; in array mode one per queue."""
    rows = with_config(plan, conf)
    if mode == ARRAY_MODE:
        return rows.withColumn("task", F.lit(1).cast("long"))
    return expand_by_count(rows, "new_tasks", "task")
