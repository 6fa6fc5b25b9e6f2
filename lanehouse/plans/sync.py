"""Incremental load of a table by key watermark, then refresh of one tracked column."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lanehouse.functions import columns as fn
from lanehouse.operators.aggregates import max_or_zero
from lanehouse.operators.filters import above_watermark
from lanehouse.operators.joins import update_tracked
from lanehouse.session import settle
from lanehouse.sources import keyed


@dataclass(frozen=True)
class SyncedTable:
    source: str
    target: str
    key: str
    columns: tuple[str, ...]
    timestamps: tuple[str, ...]
    tracked: str


# The tables kept in step
PROJECT = SyncedTable(
    source="project",
    target="raw_project",
    key="project_id",
    columns=(
        "project_id",
        "project_igf_id",
        "project_name",
        "start_timestamp",
        "description",
        "status",
        "deliverable",
    ),
    timestamps=("start_timestamp",),
    tracked="status",
)
PIPELINE = SyncedTable(
    source="pipeline",
    target="raw_pipeline",
    key="pipeline_id",
    columns=(
        "pipeline_id",
        "pipeline_name",
        "pipeline_db",
        "pipeline_type",
        "is_active",
        "date_stamp",
    ),
    timestamps=("date_stamp",),
    tracked="is_active",
)
USER = SyncedTable(
    source="user",
    target="raw_user",
    key="user_id",
    columns=("user_id", "user_igf_id", "name", "email_id", "status"),
    timestamps=(),
    tracked="status",
)


def new_rows(
    source: DataFrame,
    target: DataFrame,
    key: str,
    columns: Sequence[str],
    timestamps: Sequence[str] = (),
) -> DataFrame:
    """Rows to append: keys above the watermark of the target, timestamps normalised.

    Key 0 never enters an empty target, and a key below the watermark stays out.
    """
    return above_watermark(source, target, key).select(
        *(fn.normalise_ts(c).alias(c) if c in timestamps else F.col(c) for c in columns)
    )


def incremental_sync(
    source: DataFrame,
    target: DataFrame,
    key: str,
    columns: Sequence[str],
    timestamps: Sequence[str],
    tracked: str,
) -> DataFrame:
    """The target after the load and the refresh.

    A loaded row holds the tracked value of the source already, so only the former target is
    joined for the refresh, and only with source rows up to the watermark.
    """
    loaded = new_rows(source, target, key, columns, timestamps)
    known = source.where(F.col(key) <= max_or_zero(target, key).scalar())
    refreshed = update_tracked(target.select(*columns), known, key, tracked)
    return refreshed.unionByName(loaded)


def sync_table(spec: SyncedTable, source: DataFrame, target: DataFrame) -> DataFrame:
    return incremental_sync(
        source, target, spec.key, spec.columns, spec.timestamps, spec.tracked
    )


def sync_in_place(
    spec: SyncedTable, source: DataFrame, path: str, schema: StructType, width: int
) -> list[int]:
    """``sync_table`` on a table that ``write_keyed`` has written, in place; gives the ranges rewritten.

    Of the target only the key and the tracked column are joined, to find what differs. The ranges of these
    keys and of the loaded ones are named, and the rows of these alone are read whole and written again. A
    job that is lost on the way can be run again: what is done already is no change any more.
    """
    spark = source.sparkSession
    target = keyed.read_keyed(spark, path, schema)
    loaded = settle(new_rows(source, target, spec.key, spec.columns, spec.timestamps), "loaded")
    known = source.where(F.col(spec.key) <= max_or_zero(target, spec.key).scalar())
    tracked = target.select(spec.key, F.col(spec.tracked).alias("_before"), F.col(spec.tracked))
    renewed = update_tracked(tracked, known, spec.key, spec.tracked)
    # where the tracked column has changed; NULL on either side is none
    changes = settle(
        renewed.where(F.col("_before") != F.col(spec.tracked)).select(spec.key, spec.tracked), "changes"
    )
    numbers = keyed.range_of(spec.key, width)
    # one number per range that changes, at most as many as the table has folders
    touched = [r[0] for r in changes.select(numbers).union(loaded.select(numbers)).distinct().collect()]
    if touched:
        part = target.where(F.col(keyed.RANGE).isin(touched))
        refreshed = update_tracked(part, changes, spec.key, spec.tracked)
        whole = refreshed.unionByName(loaded.withColumn(keyed.RANGE, numbers))
        keyed.rewrite_ranges(whole.select(*schema.names, keyed.RANGE), path)
    return sorted(touched)
