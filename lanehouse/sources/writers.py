"""Sinks. None of them may write to a path that the frame itself is read from."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.session import folder_exists, remove_folder, rename_folder


# A table that is being replaced: the new one until it is whole, and the old one until it is gone
NEXT, LAST = ".next", ".last"


def snapshot_replace(df: DataFrame, path: str) -> None:
    """Replace the whole table at ``path``, which may be one that ``df`` reads.

    The new table is written beside the old one and takes its place by two renames when it is whole; then the
    old one goes. A write that fails leaves the old table. A job that is lost between the renames leaves it
    beside its place, where ``snapshot_scan`` finds it and the next replacement puts it back first. One job at
    a time may replace a table.
    """
    spark = df.sparkSession
    bare = path.rstrip("/")
    if not folder_exists(spark, bare) and folder_exists(spark, bare + LAST):
        rename_folder(spark, bare + LAST, bare)
    remove_folder(spark, bare + NEXT)
    df.write.parquet(bare + NEXT)
    remove_folder(spark, bare + LAST)
    if folder_exists(spark, bare):
        rename_folder(spark, bare, bare + LAST)
    rename_folder(spark, bare + NEXT, bare)
    remove_folder(spark, bare + LAST)


def snapshot_scan(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, or the one beside it that a replacement has just taken from its place."""
    bare = path.rstrip("/")
    return spark.read.parquet(bare if folder_exists(spark, bare) else bare + LAST)


def bucketed_snapshot(df: DataFrame, table: str, key: str, buckets: int, path: str) -> None:
    """Replace a catalog table bucketed by its key, so that later joins on it need no shuffle."""
    (
        df.write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )


def append(df: DataFrame, path: str) -> None:
    """Add rows; their files come to the table when all of them are written, so a failed write adds none."""
    df.write.mode("append").parquet(path)


def write_new(df: DataFrame, path: str, kind: str = "parquet", **options) -> None:
    """Write and fail when the destination exists."""
    df.write.mode("errorifexists").format(kind).options(**options).save(path)


def tsv_sink(df: DataFrame, path: str) -> None:
    """Tab-separated lines without a header; fails when the destination exists."""
    write_new(df, path, "csv", sep="\t", header=False)


def json_sink(df: DataFrame, path: str) -> None:
    write_new(df, path, "json")


def file_per_row(df: DataFrame, folder: str, path: str, content: str) -> None:
    """A file of its own below ``folder`` for each row, with exactly the bytes of ``content``; NULL gives none.

    ``path`` is relative to the folder. A file is written beside its place and renamed, so a task that runs
    again leaves the same file; the paths have to differ. Works on the file systems that Arrow knows.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, top = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, data in zip(batch["path"], batch["content"], strict=True):
                home, _, own = f"{top}/{name}".rpartition("/")
                files.create_dir(home, recursive=True)
                beside = f"{home}/.{own}-{uuid.uuid4().hex}"
                with files.open_output_stream(beside) as stream:
                    stream.write(data)
                files.move(beside, f"{home}/{own}")
            yield batch[["path"]]

    rows = df.where(F.col(content).isNotNull()).select(
        F.col(path).cast("string").alias("path"), F.col(content).cast("binary").alias("content")
    )
    rows.mapInPandas(write, "path string").write.format("noop").mode("overwrite").save()


def manifest_lines(manifest: DataFrame, path: str = "path") -> DataFrame:
    """Lines of digest, two spaces and path."""
    return manifest.select(F.concat("md5", F.lit("  "), path).alias("value"))


def manifest_sink(manifest: DataFrame, destination: str, path: str = "path") -> None:
    write_new(manifest_lines(manifest, path), destination, "text")


def snapshot_backup(df: DataFrame, path: str, date: str) -> None:
    """Ours: one dated copy per run below ``path``; a second run of a day replaces its copy."""
    df.withColumn("snapshot_date", F.lit(date)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("snapshot_date").parquet(path)


def newest_snapshots(backups: DataFrame, keep: int) -> DataFrame:
    """Ours: the rows of the newest ``keep`` dated copies."""
    oldest_kept = (
        backups.select("snapshot_date")
        .distinct()
        .orderBy(F.desc("snapshot_date"))
        .limit(keep)
        .agg(F.min("snapshot_date"))
    )
    return backups.where(F.col("snapshot_date") >= oldest_kept.scalar())


def prune_snapshots(spark: SparkSession, path: str, keep: int) -> list[str]:
    """Ours: remove all but the newest ``keep`` dated copies below ``path``; gives the removed dates.

    Only whole folders of a date are removed, never files within one.
    """
    if keep < 1:
        raise ValueError("at least one copy has to stay")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    dated = sorted(
        status.getPath().getName()
        for status in files.listStatus(where)
        if status.isDirectory() and status.getPath().getName().startswith("snapshot_date=")
    )
    for name in dated[:-keep]:
        remove_folder(spark, f"{path}/{name}")
    return [name.removeprefix("snapshot_date=") for name in dated[:-keep]]


def metadata_dump(**tables: DataFrame) -> DataFrame:
    """Ours: every row of several tables as one JSON line with the name of its table."""
    return reduce(
        DataFrame.unionByName,
        (
            df.select(F.lit(name).alias("table"), F.to_json(F.struct("*")).alias("row"))
            for name, df in tables.items()
        ),
    )
