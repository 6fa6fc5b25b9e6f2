"""Manifests kept with a digest per folder, so that a comparison opens only what differs."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.operators.joins import manifest_verify
from lanehouse.session import settle

#: folders are dealt by a hash of their path to so many parts of the table of files
PARTS = 256
FOLDERS, FILES = "folders", "files"
#: hexadecimal digits of a digest that one sum takes
DIGITS = 15


def _sums(prefix: str, mine: Column) -> list[Column]:
    """Two sums of parts of the digests of the rows that are ``mine``: the order of files plays no part."""

    def part(k: int) -> Column:
        digits = F.substring("_line", 1 + DIGITS * k, DIGITS)
        return F.when(mine, F.conv(digits, 16, 10).cast("decimal(38,0)")).otherwise(0)

    return [F.sum(part(k)).alias(f"{prefix}{k}") for k in (0, 1)]


def folder_digests(manifest: DataFrame, path: str = "path") -> DataFrame:
    """A row per folder: ``folder``, its ``parent``, ``depth``, ``files`` below it, and two digests.

    ``all0`` and ``all1`` sum over the files at any depth below, ``own0`` and ``own1`` over those directly in
    it. Every file counts once for each folder above it, summed within tasks first; the top folder is the
    empty path, and a file's line is its path and md5, NULL as the empty text.
    """
    steps = F.split(path, "/")
    # the path of each folder above a file: none, the first step, the first two, ...
    above = F.transform(
        F.sequence(F.lit(0), F.size(steps) - 1), lambda k: F.array_join(F.slice(steps, 1, k), "/")
    )
    line = F.md5(F.concat_ws("  ", F.coalesce("md5", F.lit("")), path))
    rows = manifest.select(line.alias("_line"), (F.size(steps) - 1).alias("_last"), F.posexplode(above))
    return (
        rows.groupBy(F.col("col").alias("folder"), F.col("pos").alias("depth"))
        .agg(
            F.count(F.lit(1)).alias("files"),
            *_sums("all", F.lit(True)),
            *_sums("own", F.col("pos") == F.col("_last")),
        )
        .withColumn("parent", F.when(F.col("depth") > 0, F.regexp_replace("folder", "(^|/)[^/]*$", "")))
    )


def _part(folder: str) -> Column:
    return F.pmod(F.xxhash64(folder), F.lit(PARTS)).cast("int").alias("part")


def write_tree(manifest: DataFrame, where: str, path: str = "path") -> None:
    """Write the folders' digests, and the files by the part of their folder; fails if there is something."""
    folder_digests(manifest, path).write.parquet(f"{where}/{FOLDERS}")
    folder = F.regexp_replace(path, "(^|/)[^/]*$", "").alias("folder")
    files = manifest.select(folder, F.col(path).alias("path"), "md5").withColumn("part", _part("folder"))
    files.repartition("part").sortWithinPartitions("folder").write.partitionBy("part").parquet(
        f"{where}/{FILES}"
    )


class Comparison(NamedTuple):
    """``verdicts`` of paths that aren't OK, the ``folders`` whose own files differ, and ``parts`` read."""

    verdicts: DataFrame
    folders: DataFrame
    parts: list[int]


def compare_trees(spark: SparkSession, expected: str, actual: str) -> Comparison:
    """``manifest_verify`` of two written trees, less the rows that are OK, from the top.

    A folder with equal digests on both sides is left closed with all below it. Level by level, those that
    differ, or are on one side only, give the folders to look at next. Files are read of the parts alone in
    which a folder has other files of its own.
    """
    sides = [spark.read.parquet(f"{where}/{FOLDERS}") for where in (expected, actual)]
    sums = [f"{kind}{k}" for kind in ("all", "own") for k in (0, 1)]
    opened, depth, levels = None, 0, []
    while opened is None or not opened.isEmpty():
        want, have = (side.where(F.col("depth") == depth) for side in sides)
        if opened is not None:
            names = opened.select(F.col("folder").alias("parent"))
            want, have = (side.join(names, "parent", "left_semi") for side in (want, have))
        one = want.select("folder", F.struct("files", *sums).alias("_want"))
        other = have.select("folder", F.struct("files", *sums).alias("_have"))
        both = one.join(other, "folder", "full_outer").where(~F.col("_want").eqNullSafe(F.col("_have")))
        own = [
            F.coalesce(f"_want.own{k}", F.lit(0)) == F.coalesce(f"_have.own{k}", F.lit(0)) for k in (0, 1)
        ]
        opened = settle(both.select("folder", (~(own[0] & own[1])).alias("own_differ")), "opened")
        levels.append(opened)
        depth += 1
    folders = settle(reduce(DataFrame.unionByName, levels).where("own_differ").select("folder"), "differing")
    parts = sorted(r[0] for r in folders.select(_part("folder")).distinct().collect())
    want, have = (
        spark.read.schema("folder string, path string, md5 string, part int")
        .parquet(f"{where}/{FILES}")
        .where(F.col("part").isin(parts))
        .join(folders, "folder", "left_semi")
        .select("path", "md5")
        for where in (expected, actual)
    )
    verdicts = manifest_verify(want, have).where("verdict <> 'OK'")
    return Comparison(verdicts, folders, parts)
