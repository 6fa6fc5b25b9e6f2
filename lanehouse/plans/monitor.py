"""Storage, replication and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators.aggregates import (
    healthy,
    merge_json,
    run_counts,
    status_counts,
    storage_totals,
)
from lanehouse.operators.numbering import position_within
from lanehouse.operators.sets import union_all
from lanehouse.operators.windows import context_of_text

# Fields of a disk line (used, available, mount) and of a quota line (used, limit)
DISK_FIELDS = (3, 4, 6)
QUOTA_FIELDS = (13, 15)
QUOTA_LINE = "Live"


def disk_usage(lines: DataFrame, volume: str, host: str = "host") -> DataFrame:
    """``(host, used, avail)`` from the disk lines that name a volume."""
    text = F.split(fn.tokens("line", DISK_FIELDS), " ")
    return lines.where(fn.has_text("line", volume)).select(
        host,
        F.get(text, F.lit(0)).try_cast("long").alias("used"),
        F.get(text, F.lit(1)).try_cast("long").alias("avail"),
    )


def quota_usage(texts: DataFrame, share: str, text: str = "text") -> DataFrame:
    """``(host, used, avail)`` from quota texts: the live line at or after the name of the share."""
    near = F.filter(
        context_of_text(F.col(text), share), lambda spot: spot["line"].contains(QUOTA_LINE)
    )
    spots = texts.select("host", F.explode(near).alias("spot"))
    parts = F.split(fn.cut_spaces("spot.line", QUOTA_FIELDS), " ")
    return spots.select(
        "host",
        F.get(parts, F.lit(0)).try_cast("long").alias("used"),
        (F.get(parts, F.lit(1)).try_cast("long") - F.get(parts, F.lit(0)).try_cast("long")).alias(
            "avail"
        ),
    )


def storage_report(*usages: DataFrame) -> DataFrame:
    """Totals per host over all kinds of reports."""
    return storage_totals(union_all(*usages))


def replication_health(status: DataFrame, server: Sequence[str], state: str) -> DataFrame:
    """Every server and whether it replicates."""
    return healthy(status, server, state)


def failing_servers(status: DataFrame, server: Sequence[str], state: str) -> DataFrame:
    return replication_health(status, server, state).where(~F.col("healthy")).select(*server)


def summary_rows(**summaries: DataFrame) -> DataFrame:
    """The rows of several summaries as JSON: ``section``, ``position`` from 1 in the section, ``row``."""
    rows = union_all(
        *(
            df.select(F.lit(name).alias("section"), F.to_json(F.struct("*")).alias("row"))
            for name, df in summaries.items()
        )
    )
    return position_within(rows, ["section"], ["row"]).select("section", "position", "row")


def admin_summary(
    runs: DataFrame,
    ts: str,
    kind: str,
    usage: DataFrame,
    pipelines: DataFrame,
    pipeline: str,
    status: str,
) -> DataFrame:
    """Run counts, storage totals and pipeline status counts as rows of three sections."""
    return summary_rows(
        pipelines=status_counts(pipelines, pipeline, status),
        seqruns=run_counts(runs, ts, kind),
        storage=storage_totals(usage),
    )


def summary_totals(**summaries: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """One document with the number of rows and the sums of the named columns of each summary."""
    return merge_json(
        **{
            name: df.agg(
                F.to_json(
                    F.struct(
                        F.count(F.lit(1)).alias("rows"),
                        *(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in columns),
                    )
                ).alias("document")
            )
            for name, (df, columns) in summaries.items()
        }
    )
