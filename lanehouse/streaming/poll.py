"""Scheduled polls of a report folder: each run lands what has arrived since the run before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn


def report_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Ordered lines ``(file, pos, line)`` of reports as they arrive, a report read as one cell."""
    texts = spark.readStream.text(folder, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), "value"
    )
    return texts.select("file", F.posexplode(fn.text_lines("value")).alias("pos", "line"))


def land(stream: DataFrame, path: str, progress: str) -> None:
    """Append what has arrived to the parquet table at ``path`` and return.

    ``progress`` is a folder of the shared file system that remembers what has been read; a run that
    was lost half-way is repeated without doubling its rows.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
