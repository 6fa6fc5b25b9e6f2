"""Cycle masks and the labels of sample sheets. The rules here are ours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lanehouse.functions.columns import ColumnOrName, as_column

# Fixed values
SHEET_NAME = "SampleSheet_%s_%s_%s.csv"
MASK_PART = r"[YIN]\d+"


def mask_segments(mask: ColumnOrName) -> Column:
    """``Y150N1;I8N2`` as an array of (segment, kind, len), segments counted from 1."""

    def parts(segment: Column, position: Column) -> Column:
        return F.transform(
            F.regexp_extract_all(segment, F.lit(MASK_PART), F.lit(0)),
            lambda part: F.struct(
                (position + 1).alias("segment"),
                F.substring(part, 1, 1).alias("kind"),
                part.substr(F.lit(2), F.length(part)).cast("int").alias("len"),
            ),
        )

    return F.flatten(F.transform(F.split(as_column(mask), ";"), parts))


def cycles(mask: ColumnOrName, kind: str | None = None) -> Column:
    """Total number of cycles, of one kind if given."""
    segments = mask_segments(mask)
    if kind is not None:
        segments = F.filter(segments, lambda part: part["kind"] == kind)
    return F.aggregate(segments, F.lit(0), lambda total, part: total + part["len"])


def index_len(mask: ColumnOrName) -> Column:
    return cycles(mask, "I")


def group_label(length: ColumnOrName, tag: ColumnOrName) -> Column:
    return F.concat_ws("_", as_column(length).cast("string"), as_column(tag))


def sheet_name(project: ColumnOrName, lane: ColumnOrName, group: ColumnOrName) -> Column:
    return F.format_string(
        SHEET_NAME, as_column(project), as_column(lane).cast("string"), as_column(group)
    )
