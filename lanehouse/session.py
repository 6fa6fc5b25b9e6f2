"""Session helpers: the shared work folder and written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_seen: set[tuple[str, str]] = set()
_jobs: list[str] = []


def local_session(cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lanehouse")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether tasks run in this process; with ``local-cluster`` they don't."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def on_one_machine(spark: SparkSession) -> bool:
    """Whether all executors see the disk of the driver's machine."""
    return spark.sparkContext.master.startswith("local")


def on_local_disk(folder: str, default: str) -> bool:
    """Whether ``folder`` lies on a local disk, where ``default`` is the file system of bare paths."""
    scheme = folder.partition(":")[0] if ":" in folder.partition("/")[0] else default.partition(":")[0]
    return scheme == "file"


def seen_by_executors(spark: SparkSession, folder: str) -> bool:
    """Whether what the driver writes to ``folder``, on a disk, is there for tasks in processes besides its own.

    Such a folder may be a mount that all machines have, which its name doesn't tell.
    """
    context = spark.sparkContext
    files, mark = _on_its_system(spark, f"{folder}/seen-{uuid.uuid4().hex}")
    path = files.makeQualified(mark).toUri().getPath()
    tasks = 2 * context.defaultParallelism

    def look(_):
        time.sleep(0.1)  # so that no executor takes all tasks
        yield os.path.isdir(path)

    try:
        files.mkdirs(mark)
        seen = context.parallelize(range(tasks), tasks).mapPartitions(look).collect()
        return len(context._jsc.sc().statusTracker().getExecutorInfos()) > 1 and all(seen)
    finally:
        files.delete(mark, True)


def work_folder(spark: SparkSession) -> str:
    """The shared folder of the cluster: ``spark.checkpoint.dir``, or that of ``setCheckpointDir``.

    Without one, it is a temporary folder in sessions of one process and a folder beside the tables of the
    warehouse in all others. A folder of one machine's disk is refused on a cluster, as other executors would
    not see the files.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    application = context.applicationId
    if not folder and is_local(spark):
        if application not in _local_folders:
            _local_folders[application] = tempfile.mkdtemp(prefix="lanehouse-")
        return _local_folders[application]
    folder = folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/lanehouse-work"
    default = spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if not on_one_machine(spark) and on_local_disk(folder, default) and (application, folder) not in _seen:
        if not seen_by_executors(spark, folder):
            raise RuntimeError(
                f"{folder} is on a local disk: set spark.checkpoint.dir to a folder every executor can reach"
            )
        _seen.add((application, folder))
    return folder


def _on_its_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder with all files in it, on whatever file system it is; none is no error."""
    files, where = _on_its_system(spark, path)
    files.delete(where, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, where = _on_its_system(spark, path)
    return files.exists(where)


def rename_folder(spark: SparkSession, path: str, new: str) -> None:
    """Give a folder a name that no other has."""
    files, where = _on_its_system(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    if files.exists(target) or not files.rename(where, target):
        raise RuntimeError(f"{path} can't be renamed to {new}")


@contextmanager
def job(spark: SparkSession) -> Iterator[str]:
    """A folder for the intermediate tables of one job, removed at its end.

    Frames made inside read from it, so their results have to be used before the ``with`` ends. What is
    written outside of any job stays in the work folder.
    """
    folder = f"{work_folder(spark)}/job-{uuid.uuid4().hex}"
    _jobs.append(folder)
    try:
        yield folder
    finally:
        _jobs.remove(folder)
        remove_folder(spark, folder)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the folder of the running job, or the work folder, that nothing has been written to."""
    folder = _jobs[-1] if _jobs else work_folder(spark)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the work folder and read it back.

    Cuts the lineage so that values which depend on the placement of rows stay as they are when an
    executor is lost, and gives the planner the true size, so that its own broadcast threshold decides.
    A join side that was grouped before is settled for one more reason: AQE splits a hot key of the
    other side only where both sides come straight from a shuffle.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
