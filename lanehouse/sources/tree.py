"""All files below a folder, found by tasks."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lanehouse.functions import columns as fn
from lanehouse.session import settle
from lanehouse.sources.readers import MANIFEST_NAME

#: tasks that list the folders of one round, at most
LISTING_TASKS = 10_000

ENTRIES = pa.schema(
    [
        ("path", pa.string()),
        ("is_folder", pa.bool_()),
        ("length", pa.int64()),
        ("modified", pa.timestamp("us", "UTC")),
    ]
)


def spread(rows: DataFrame, n: int, key: str = "path") -> DataFrame:
    """``rows`` dealt to as many tasks as there is work for; AQE would put a few names into one task."""
    return rows.repartition(min(max(n, 1), LISTING_TASKS), key)


def listed(folders: DataFrame, folder: str) -> DataFrame:
    """What lies directly in each of ``folders``, which are named as the file system of ``folder`` does."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = fs.FileSystem.from_uri(folder)
        local = files.type_name == "local"
        for batch in batches:
            for path in batch.column("path").to_pylist():
                # a folder below the top one may be gone by now
                selector = fs.FileSelector(path, allow_not_found=path != top)
                found = [
                    info
                    for info in files.get_file_info(selector)
                    if not (local and os.path.islink(info.path))
                ]
                columns = (
                    [info.path for info in found],
                    [info.type == fs.FileType.Directory for info in found],
                    [info.size for info in found],
                    [info.mtime for info in found],
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, ENTRIES, strict=True)], schema=ENTRIES
                )

    return folders.mapInArrow(entries, from_arrow_schema(ENTRIES))


def file_tree(spark: SparkSession, folder: str, manifest: str = MANIFEST_NAME) -> DataFrame:
    """``path``, ``length`` and ``modified`` of all files below ``folder``, as ``find -type f`` has them.

    Files without content and hidden ones count; links don't, and the manifest doesn't. The tree is walked
    in rounds, one per level: tasks list the folders of a level, and what they find is written, so the driver
    learns only how many folders there are. Works on the file systems that Arrow knows; a folder that isn't
    there is an error.
    """
    top = fs.FileSystem.from_uri(folder)[1].rstrip("/") or "/"
    folders, n, levels = spark.createDataFrame([(top,)], "path string"), 1, []
    while n:
        level = settle(listed(spread(folders, n), folder), "level")
        levels.append(level)
        folders = level.where("is_folder").select("path")
        n = folders.count()
    found = reduce(DataFrame.unionByName, levels).where("NOT is_folder")
    return found.where(fn.base_name("path") != manifest).select("path", F.col("length"), "modified")
