"""MD5 of files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.session import settle
from lanehouse.sources.tree import file_tree, spread

PIECE_BYTES = 1 << 24
#: bytes, and files, that a task is given on average
TASK_BYTES = 1 << 28
TASK_FILES = 100


def file_md5(spark: SparkSession, folder: str, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``(md5, path, length)`` of every file below ``folder``; paths begin with its own name.

    Every file is read as a stream of pieces, so a task holds one piece whatever the file's size. The list
    of files is written first, and there are as many tasks as its bytes and files ask for.
    """

    def hash_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            digests = []
            for path in batch["path"]:
                digest = hashlib.md5()
                with files.open_input_stream(path) as stream:
                    while piece := stream.read(piece_bytes):
                        digest.update(piece)
                digests.append(digest.hexdigest())
            yield batch.assign(md5=digests)

    found = settle(file_tree(spark, folder).select("path", "length"), "tree")
    n, size = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(n // TASK_FILES, size // TASK_BYTES, min(n, spark.sparkContext.defaultParallelism))
    hashed = spread(found, tasks).mapInPandas(hash_pieces, "path string, length long, md5 string")
    above = fs.FileSystem.from_uri(folder)[1].rstrip("/").rpartition("/")[0] + "/"
    return hashed.select("md5", F.substr("path", F.lit(len(above) + 1)).alias("path"), "length")
