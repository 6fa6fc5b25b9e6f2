"""Sample sheets of a run: labels, indexes, counts and the tasks that follow. Rules are ours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanehouse.functions import masks
from lanehouse.operators.aggregates import nested_counts
from lanehouse.operators.levels import indexes_within
from lanehouse.operators.sets import expand_by_count

# Fixed values
SHEET_COLUMNS = (
    "project",
    "project_index",
    "lane",
    "lane_index",
    "bases_mask",
    "index_group",
    "index_group_index",
    "sample_counts",
    "samplesheet_file",
)
LEVELS = ("project_index", "lane_index", "index_group_index")


def formatted_sheets(samples: DataFrame, run: str = "run") -> DataFrame:
    """One record per run, project, lane, index group and mask, numbered level by level.

    ``samples`` has run, project, lane, bases_mask and tag. The samples are grouped to sheets
    before anything is numbered.
    """
    group = masks.group_label(masks.index_len("bases_mask"), "tag")
    sheets = (
        samples.groupBy(run, "project", "lane", "bases_mask", "tag")
        .agg(F.count(F.lit(1)).alias("sample_counts"))
        .withColumn("index_group", group)
        .withColumn("samplesheet_file", masks.sheet_name("project", "lane", "index_group"))
    )
    levels = {"project": "project_index", "lane": "lane_index", "index_group": "index_group_index"}
    return indexes_within(sheets, [run], levels).select(run, *SHEET_COLUMNS)


def sample_groups(sheets: DataFrame, run: str = "run") -> DataFrame:
    """The number of samples per run, project index, lane index and index group index."""
    return nested_counts(sheets, [run, *LEVELS], "sample_counts")


def sheet_tasks(sheets: DataFrame, run: str = "run") -> DataFrame:
    """One row per sample of each sheet."""
    return expand_by_count(
        sheets.select(run, *LEVELS, "sample_counts"), "sample_counts", "sample"
    ).drop("sample_counts")
