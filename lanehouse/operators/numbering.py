"""Positions in a total order of a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanehouse.operators.keys import join_null_safe
from lanehouse.session import settle

# monotonically_increasing_id keeps the partition above bit 33 and the row below it
ROW_BITS = 33


def with_position(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``position`` (from 0) and ``total``; ``order`` names columns that identify a row together.

    The rows are range-partitioned and sorted once and written, which fixes what row is where. The
    first position of each range comes from the row counts of the ranges, one row per shuffle
    partition, which the planner broadcasts as long as that is small.
    """
    placed = settle(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_placed", F.monotonically_increasing_id()),
        "ranges",
    )
    range_id = F.shiftright("_placed", ROW_BITS)
    row = F.col("_placed").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    counts = placed.groupBy(range_id.alias("_range")).agg(F.count(F.lit(1)).alias("_rows"))
    in_order = Window.orderBy("_range")
    starts = counts.select(
        "_range",
        (F.sum("_rows").over(in_order) - F.col("_rows")).alias("_start"),
        F.sum("_rows").over(Window.partitionBy()).alias("total"),
    )
    return (
        placed.withColumn("_range", range_id)
        .join(starts, "_range")
        .withColumn("position", F.col("_start") + row)
        .drop("_range", "_placed", "_start")
    )


def position_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], as_column: str = "position"
) -> DataFrame:
    """Number the rows of each key from 1 in their order; ``order`` tells the rows of a key apart.

    The positions are those in the whole table less the first of the key, so a key of any size is
    numbered by all tasks that hold a part of it. The firsts are written before the join, so that AQE
    can split a key that has many rows.
    """
    placed = with_position(df, [*keys, *order])
    firsts = settle(placed.groupBy(*keys).agg(F.min("position").alias("_first")), "firsts")
    number = F.col("position") - F.col("_first") + 1
    return (
        join_null_safe(placed, firsts, keys)
        .withColumn("_number", number)
        .drop("position", "total", "_first")
        .withColumnRenamed("_number", as_column)
    )


def chunk(df: DataFrame, order: Sequence[str], n: int, as_column: str = "chunk") -> DataFrame:
    """Number rows 1..n in near-equal runs of the order; the first ``total % n`` have one row more."""
    size = F.expr(f"total div {n}")
    longer = F.col("total") % n
    in_longer = longer * (size + 1)
    past = F.col("position") - in_longer
    number = F.when(
        F.col("position") < in_longer, F.floor(F.col("position") / (size + 1)) + 1
    ).otherwise(longer + F.floor(past / F.greatest(size, F.lit(1))) + 1)
    return (
        with_position(df, order)
        .withColumn(as_column, number.cast("long"))
        .drop("position", "total")
    )
