"""Checksum manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators.numbering import chunk
from lanehouse.sources.digests import file_md5

# Fixed values
CHECKSUM_CHUNKS = 50
MANIFEST_LINE = r"^([0-9a-f]{32})  (.+)$"


def manifest_build(spark: SparkSession, folder: str) -> DataFrame:
    return file_md5(spark, folder)


def manifest_of(rows: DataFrame, path: str, content: str) -> DataFrame:
    """The manifest of contents held in a table."""
    return rows.select(
        fn.content_md5(content).alias("md5"),
        F.col(path).alias("path"),
        F.octet_length(content).cast("long").alias("size"),
    )


def manifest_read(spark: SparkSession, path: str) -> DataFrame:
    """``(md5, path)`` of a written manifest."""
    return spark.read.text(path).select(
        F.regexp_extract("value", MANIFEST_LINE, 1).alias("md5"),
        F.regexp_extract("value", MANIFEST_LINE, 2).alias("path"),
    )


def checksum_chunks(manifest: DataFrame, n: int = CHECKSUM_CHUNKS) -> DataFrame:
    """The files of a manifest in near-equal numbered chunks by path."""
    return chunk(manifest, ["path"], n)
