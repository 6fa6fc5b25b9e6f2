"""Sources with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lanehouse.functions import columns as fn
from lanehouse.operators.aggregates import active_count

# Documents and files read by the jobs
JOB_DUMP = "Jobs map<string, struct<Job_Name: string, job_state: string>>"
WORKER_REPLY = (
    "map<string, struct<active: array<struct<id: string, name: string>>,"
    " active_queues: array<struct<name: string>>>>"
)
ACTIVE_COUNTS = "map<string, map<string, bigint>>"
WAITING_LIST = "array<map<string, bigint>>"
WORKFLOW_INPUTS = "inputs struct<sample_and_unmapped_bams: struct<sample_name: string>>"
POOLS = "pool_name string, slots int"
MANIFEST_NAME = "file_manifest.md5"
JDBC_PARTITIONS = 8


def scan(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table kept as parquet under ``folder``."""
    return spark.read.parquet(f"{folder}/{table}.parquet")


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = JDBC_PARTITIONS,
    **options: str,
) -> DataFrame:
    """A table of a database, read in ranges of ``column`` when one is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if column is not None:
        reader = reader.options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    return reader.options(**options).load()


def json_scan(spark: SparkSession, path: str, schema: str | StructType, multiline: bool = False) -> DataFrame:
    """JSON lines, read in splits; with ``multiline`` each file is one document and one task.

    Dumps that a program writes as one indented document need ``multiline``.
    """
    return spark.read.schema(schema).json(path, multiLine=multiline)


def csv_scan(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False)


def line_scan(spark: SparkSession, path: str) -> DataFrame:
    """Ordered lines ``(file, pos, line)`` of many small reports; a file is read as one cell."""
    texts = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), "value"
    )
    return texts.select("file", F.posexplode(fn.text_lines("value")).alias("pos", "line"))


def split_line_scan(spark: SparkSession, path: str) -> DataFrame:
    """Ordered lines ``(file, block, pos, line)`` of files of any size.

    A file is read in splits. ``block`` is the offset of the split and ``pos`` ascends within it, so
    the pair orders the lines of a file without counting the lines before.
    """
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )


def job_dump(documents: DataFrame, column: str = "value") -> DataFrame:
    """``(job_id, job_name, job_state)`` rows of job dumps held as JSON text."""
    jobs = F.from_json(column, JOB_DUMP)["Jobs"]
    return documents.select(F.explode(jobs).alias("job_id", "job")).select(
        "job_id", F.col("job.Job_Name").alias("job_name"), F.col("job.job_state").alias("job_state")
    )


def worker_list(documents: DataFrame, column: str = "value") -> DataFrame:
    """``(worker_id, active_jobs, queues)`` rows of worker replies held as JSON text."""
    workers = documents.select(
        F.explode(F.from_json(column, WORKER_REPLY)).alias("worker_id", "worker")
    )
    return active_count(workers, "worker.active").select(
        "worker_id", "active_jobs", fn.names("worker.active_queues").alias("queues")
    )


def active_counts(documents: DataFrame, column: str = "value") -> DataFrame:
    """``(queue, state, n)`` rows of documents ``{queue: {state: n}}`` held as base64 of JSON."""
    counts = fn.parse_json(fn.from_b64(column), ACTIVE_COUNTS)
    others = [c for c in documents.columns if c != column]
    return documents.select(*others, F.explode(counts).alias("queue", "states")).select(
        *others, "queue", F.explode("states").alias("state", "n")
    )


def waiting_list(documents: DataFrame, column: str = "value") -> DataFrame:
    """``(queue, waiting)`` rows of documents ``[{queue: waiting}, ...]`` held as JSON."""
    others = [c for c in documents.columns if c != column]
    entries = F.explode(fn.parse_json(column, WAITING_LIST)).alias("entry")
    return documents.select(*others, entries).select(
        *others, F.explode("entry").alias("queue", "waiting")
    )


def file_scan(spark: SparkSession, folder: str, manifest: str = MANIFEST_NAME) -> DataFrame:
    """All files below ``folder`` except its manifest; content is read only where it is used.

    Spark's scan passes over files of length 0, so these are not listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.where(fn.base_name("path") != manifest)
