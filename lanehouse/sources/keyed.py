"""Tables kept in ranges of their key, so that a change rewrites the ranges it touches and no more."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RANGE = "key_range"


def range_of(key: str, width: int) -> Column:
    """The number of the range of ``width`` keys; NULL for a NULL key."""
    return F.floor(F.col(key) / width).cast("long").alias(RANGE)


def write_keyed(df: DataFrame, path: str, key: str, width: int) -> None:
    """Write a new table with a folder per range; fails when the destination exists."""
    ranged = df.withColumn(RANGE, range_of(key, width))
    ranged.repartition(RANGE).write.partitionBy(RANGE).parquet(path)


def read_keyed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table with its column ``key_range``; a condition on that reads the folders of these ranges alone."""
    return spark.read.schema(StructType([*schema.fields, *_range_field()])).parquet(path)


def _range_field():
    return StructType().add(RANGE, "long").fields


def rewrite_ranges(rows: DataFrame, path: str) -> None:
    """Replace the ranges that ``rows``, with their ``key_range``, have rows of; all other files stay.

    The new files are written beside the table and take the place of the old ones when all of them are
    there, so ``rows`` may read the table itself.
    """
    rows.repartition(RANGE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        RANGE
    ).parquet(path)
