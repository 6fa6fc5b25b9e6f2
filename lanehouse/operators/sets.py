"""Unions, expansion of rows, and functions mapped over groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows one input row may become within a task before they are spread
EXPANSION_BLOCK = 1 << 16


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def append_when(df: DataFrame, row: Mapping[str, Column], condition: DataFrame) -> DataFrame:
    """The frame, and one literal row more when ``condition`` has any row."""
    extra = condition.limit(1).select(*(value.alias(name) for name, value in row.items()))
    return df.unionByName(extra)


def flatten_groups(df: DataFrame, values: str, as_column: str) -> DataFrame:
    """One row per element of an array column."""
    others = [c for c in df.columns if c != values]
    return df.select(*others, F.explode(values).alias(as_column))


def expand_by_count(df: DataFrame, n: str, as_column: str = "item") -> DataFrame:
    """One row per whole number 1..n; none for n below 1.

    A row of one block of numbers is expanded where it is. One of more is cut into blocks, and only these are
    dealt to the tasks before they are expanded.
    """
    count = F.col(n).cast("long")
    last_block = F.floor((count - 1) / EXPANSION_BLOCK)
    first = F.col("_block") * EXPANSION_BLOCK + 1
    short = df.where((count >= 1) & (count <= EXPANSION_BLOCK)).withColumn(
        as_column, F.explode(F.sequence(F.lit(1).cast("long"), count))
    )
    blocks = df.where(count > EXPANSION_BLOCK).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("long"), last_block))
    )
    long = (
        blocks.repartition(*df.columns, "_block")
        .withColumn(
            as_column,
            F.explode(F.sequence(first, F.least(first + EXPANSION_BLOCK - 1, count))),
        )
        .drop("_block")
    )
    return short.unionByName(long)


def expand_nested(df: DataFrame, nested: str, names: Sequence[str], n: str) -> DataFrame:
    """Rows of a map of maps of counts: one name per level of keys, ``n`` for the count."""
    rows = df.withColumnRenamed(nested, "_rest")
    others = [c for c in rows.columns if c != "_rest"]
    for name in names:
        rows = rows.select(*others, F.explode("_rest").alias(name, "_rest"))
        others.append(name)
    return rows.withColumnRenamed("_rest", n)


def map_groups(
    df: DataFrame,
    keys: Sequence[str],
    fn: Callable[..., pd.DataFrame],
    schema: str,
    merge: Sequence[Column],
    **fixed,
) -> DataFrame:
    """Call ``fn(frame, **fixed)`` for batches of each group and merge what it returns per group.

    Every group comes in batches, whatever its size, and a batch holds rows of one group only. ``fn``
    returns rows of ``schema``, which has the keys; ``merge`` are the aggregates that make one row of
    all rows of a group. Only what ``fn`` returns is shuffled.
    """

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, frame in batch.groupby(list(keys), dropna=False, sort=False):
                yield fn(frame.reset_index(drop=True), **fixed)

    return df.mapInPandas(call, schema).groupBy(*keys).agg(*merge)


def map_whole_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    fn: Callable[..., Iterator[pa.RecordBatch]],
    schema: str,
    **fixed,
) -> DataFrame:
    """Call ``fn(batches, **fixed)`` once per group, for functions that need all rows of a group in order.

    ``batches`` is an iterator over the group's rows in ``order``, so a task holds one batch of a group of any
    size; ``fn`` yields batches of ``schema``, which has the keys. One shuffle brings a group together, and its
    sort serves the grouping too. Such a function can't be split: its largest group is one task's work, in
    constant memory. What can be merged belongs into ``map_groups``.
    """

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches, **fixed)

    # the form with an iterator is told by its types, which have to be names of this module's
    call.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    in_order = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    return in_order.groupBy(*keys).applyInArrow(call, schema)
