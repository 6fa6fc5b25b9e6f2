"""Grouped results. Rows are combined on the map side wherever the result allows it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators.numbering import position_within

# Fixed values
ACTIVE_STATES = ["Q", "R"]
QUEUED_STATE = "Q"
RUNNING_STATE = "R"
PRIVATE_QUEUE_PREFIXES = ["_", "unacked"]
HEALTHY_TEXT = "ON"
REPORT_TOOLS = ["bclconvert", "fastqc", "fastqscreen"]


def whole(column: Column) -> Column:
    return F.coalesce(column, F.lit(0)).cast("long")


def max_or_zero(df: DataFrame, key: str) -> DataFrame:
    """One row: the highest key, 0 when there is none."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).alias(key))


def last_per_group(
    df: DataFrame,
    column: str,
    filters: Sequence[Column] = (),
    group_by: Sequence[str] = (),
) -> DataFrame:
    """The highest value per group of the filtered rows; without a group, one row."""
    for condition in filters:
        df = df.where(condition)
    return df.groupBy(*group_by).agg(F.max(column).alias("last"))


def queue_depth(messages: DataFrame, queue: str = "queue") -> DataFrame:
    """Waiting messages per queue; the broker's own queues are left out."""
    own = fn.starts_with_any(queue, PRIVATE_QUEUE_PREFIXES)
    return messages.where(~own).groupBy(queue).agg(F.count(F.lit(1)).alias("waiting"))


def job_counts(
    jobs: DataFrame, prefix: str = "", keys: Sequence[str] = (), name: str = "job_name"
) -> DataFrame:
    """Queued and running jobs per name as columns ``Q`` and ``R``; other states do not count."""
    state = F.col("job_state")
    return (
        jobs.where(F.col(name).startswith(prefix) & state.isin(ACTIVE_STATES))
        .groupBy(*keys, name)
        .agg(
            F.count_if(state == QUEUED_STATE).alias("Q"),
            F.count_if(state == RUNNING_STATE).alias("R"),
        )
    )


def active_by_queue(counts: DataFrame, keys: Sequence[str] = ("queue",)) -> DataFrame:
    """``(queue, state, n)`` rows to queued plus running jobs and queued jobs per queue."""
    state = F.col("state")
    queued = F.when(state == QUEUED_STATE, F.col("n")).otherwise(F.lit(0))
    return (
        counts.where(state.isin(ACTIVE_STATES))
        .groupBy(*keys)
        .agg(
            F.sum("n").cast("long").alias("active"), F.sum(queued).cast("long").alias("queued")
        )
    )


def active_total(counts: DataFrame) -> DataFrame:
    """One row: queued plus running jobs of all queues."""
    return counts.where(F.col("state").isin(ACTIVE_STATES)).agg(
        whole(F.sum("n")).alias("active")
    )


def collect_values(
    df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str] = ()
) -> DataFrame:
    """The values of each key as rows with their position from 1, ordered by ``order``, then value."""
    entries = df.select(*keys, *(c for c in order if c not in keys), value)
    numbered = position_within(entries, keys, [*order, value])
    return numbered.select(*keys, "position", value)


def active_count(workers: DataFrame, active: str, as_column: str = "active_jobs") -> DataFrame:
    """Number of entries in each worker's array of jobs; 0 when the array is missing."""
    return workers.withColumn(as_column, F.coalesce(fn.array_length(active), F.lit(0)).cast("long"))


def unique_queues(df: DataFrame, value: str, order: str, queue: str = "queue") -> DataFrame:
    """One row per queue; of several, the one written last."""
    return df.groupBy(queue).agg(F.max_by(value, order).alias(value))


def run_counts(runs: DataFrame, ts: str, kind: str) -> DataFrame:
    """Ours: runs per calendar month and kind."""
    return runs.groupBy(
        F.date_format(F.col(ts).cast("date"), "yyyy-MM").alias("month"), kind
    ).agg(F.count(F.lit(1)).alias("runs"))


def status_counts(runs: DataFrame, pipeline: str, status: str) -> DataFrame:
    """Ours: runs per pipeline and status."""
    return runs.groupBy(pipeline, status).agg(F.count(F.lit(1)).alias("runs"))


def storage_totals(disk: DataFrame, host: str = "host") -> DataFrame:
    """Ours: space used and free per host and the used share of both."""
    used = F.sum("used").cast("long")
    free = F.sum("avail").cast("long")
    share = F.when(used + free > 0, F.round(used / (used + free), 6)).otherwise(F.lit(0.0))
    return disk.groupBy(host).agg(
        used.alias("used"), free.alias("avail"), share.alias("used_share")
    )


def sample_counts(reads: DataFrame, keys: Sequence[str], n: str) -> DataFrame:
    """Ours: reads summed per sample key."""
    return reads.groupBy(*keys).agg(F.sum(n).cast("long").alias("reads"))


def fan_in(df: DataFrame, levels: Sequence[str], n: str | None = None) -> DataFrame:
    """Subtotals from the finest level up to the whole run, with the level in ``grouping``.

    The rows are summed to the finest level first, so only one row per finest group is repeated
    for the upper levels.
    """
    finest = df.groupBy(*levels).agg(
        (F.count(F.lit(1)) if n is None else F.sum(n)).cast("long").alias("n")
    )
    return finest.rollup(*levels).agg(
        F.sum("n").cast("long").alias("n"), F.grouping_id().cast("long").alias("grouping")
    )


def needs_aggregate(groups: DataFrame, analysis: str) -> DataFrame:
    """Ours: whether an analysis has more than one group."""
    return groups.groupBy(analysis).agg((F.count(F.lit(1)) > 1).alias("needs_aggregate"))


def healthy(
    status: DataFrame, server: Sequence[str], state: str, text: str = HEALTHY_TEXT
) -> DataFrame:
    """A server is healthy when any of its status rows contains ``text``."""
    return status.groupBy(*server).agg(
        F.coalesce(F.bool_or(F.col(state).contains(text)), F.lit(False)).alias("healthy")
    )


def merge_json(**documents: DataFrame) -> DataFrame:
    """One document out of one-row frames with a JSON column ``document``, keyed by their names."""
    members = [
        frame.select(F.concat(F.lit(f'"{name}":'), F.col("document")).alias("member"))
        for name, frame in documents.items()
    ]
    together = reduce(DataFrame.unionByName, members)
    body = F.concat_ws(",", F.sort_array(F.collect_list("member")))
    return together.agg(F.concat(F.lit("{"), body, F.lit("}")).alias("document"))


def ordered_reports(
    reports: DataFrame,
    keys: Sequence[str],
    tool: str,
    path: str,
    order: Sequence[str] = tuple(REPORT_TOOLS),
) -> DataFrame:
    """Ours: the report paths of each group, numbered in the order of a list of tools, others left out."""
    place = F.array_position(F.array(*(F.lit(name) for name in order)), F.col(tool))
    listed = reports.withColumn("_tool", place).where(F.col("_tool") > 0)
    return collect_values(listed, keys, path, order=["_tool"])


def nested_counts(sheets: DataFrame, keys: Sequence[str], n: str) -> DataFrame:
    """Counts summed by run, project, lane and index group, a row for each of the innermost."""
    return sheets.groupBy(*keys).agg(F.sum(n).cast("long").alias("n"))


def distinct_edges(edges: DataFrame, flow: str = "downstream") -> DataFrame:
    """``(src, dst)`` edges as distinct ``(task, neighbour)`` rows in the direction of ``flow``."""
    ends = {"downstream": ("src", "dst"), "upstream": ("dst", "src")}
    if flow not in ends:
        raise ValueError('flow must be "downstream" or "upstream"')
    task, neighbour = ends[flow]
    return edges.select(
        F.col(task).alias("task"), F.col(neighbour).alias("neighbour")
    ).distinct()


def adjacency(edges: DataFrame, flow: str = "downstream") -> DataFrame:
    """The set of neighbours of each task, a row for each."""
    return distinct_edges(edges, flow)
