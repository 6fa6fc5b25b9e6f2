"""Files: manifests, CSV and JSON round trips, digests of the table files themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators import joins, windows
from lanehouse.plans import manifest, trees
from lanehouse.session import fresh_path
from lanehouse.sources import readers, writers
from lanehouse.sources.readers import scan
from lanehouse.workload.registry import query

MANIFEST_SQL = """manifest AS (
  SELECT md5(text) AS md5, 'results/' || source || '/' || doc_id || '.txt' AS path,
         CAST(strlen(text) AS BIGINT) AS size FROM documents),
other AS (
  SELECT CASE WHEN path LIKE 'results/src5/%' THEN md5('x' || path) ELSE md5 END AS md5,
         CASE WHEN path LIKE 'results/src11/%' THEN path || '.new' ELSE path END AS path, size
  FROM manifest WHERE path NOT LIKE 'results/src13/%')"""


def documents_manifest(spark: SparkSession, folder: str) -> DataFrame:
    path = F.concat(F.concat_ws("/", F.lit("results"), "source", "doc_id"), F.lit(".txt"))
    documents = scan(spark, folder, "documents").select("doc_id", "text", path.alias("path"))
    return manifest.manifest_of(documents, "path", "text")


def other_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A copy with changed, renamed and missing files."""
    path = F.col("path")
    changed = fn.content_md5(F.concat(F.lit("x"), path))
    renamed = F.concat(path, F.lit(".new"))
    return (
        documents_manifest(spark, folder)
        .where(~path.startswith("results/src13/"))
        .select(
            F.when(path.startswith("results/src5/"), changed).otherwise(F.col("md5")).alias("md5"),
            F.when(path.startswith("results/src11/"), renamed).otherwise(path).alias("path"),
            "size",
        )
    )


@query(f"WITH {MANIFEST_SQL} SELECT md5, path, size FROM manifest")
def manifest_md5(spark: SparkSession, folder: str) -> DataFrame:
    return documents_manifest(spark, folder)


@query(f"WITH {MANIFEST_SQL} SELECT md5, path FROM manifest")
def manifest_file(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "manifest")
    writers.manifest_sink(documents_manifest(spark, folder), path)
    return manifest.manifest_read(spark, path)


@query(
    f"""
    WITH {MANIFEST_SQL}
    SELECT path, CASE WHEN o.path IS NULL THEN 'MISSING' WHEN m.path IS NULL THEN 'EXTRA'
                      WHEN m.md5 = o.md5 THEN 'OK' ELSE 'MISMATCH' END AS verdict
    FROM manifest m FULL JOIN other o USING (path)
    """
)
def manifest_verify(spark: SparkSession, folder: str) -> DataFrame:
    return joins.manifest_verify(
        documents_manifest(spark, folder), other_manifest(spark, folder)
    )


@query(
    f"""
    WITH {MANIFEST_SQL}
    SELECT path, CASE WHEN o.path IS NULL THEN 'MISSING' WHEN m.path IS NULL THEN 'EXTRA' ELSE 'MISMATCH'
                 END AS verdict
    FROM manifest m FULL JOIN other o USING (path)
    WHERE o.path IS NULL OR m.path IS NULL OR m.md5 <> o.md5
    """
)
def manifest_trees(spark: SparkSession, folder: str) -> DataFrame:
    """The same comparison from written digests of folders, of which only differing ones are opened."""
    expected, actual = fresh_path(spark, "expected"), fresh_path(spark, "actual")
    trees.write_tree(documents_manifest(spark, folder), expected)
    trees.write_tree(other_manifest(spark, folder), actual)
    return trees.compare_trees(spark, expected, actual).verdicts


@query(
    f"""
    WITH {MANIFEST_SQL}
    SELECT m.md5, m.path, m.size FROM manifest m LEFT JOIN other o ON o.path = m.path
    WHERE o.path IS NULL OR o.md5 <> m.md5 OR o.size <> m.size
    """
)
def manifest_todo(spark: SparkSession, folder: str) -> DataFrame:
    return joins.manifest_todo(documents_manifest(spark, folder), other_manifest(spark, folder))


@query(
    f"""
    WITH {MANIFEST_SQL}
    SELECT path, md5, size, ntile(50) OVER (ORDER BY path) AS chunk FROM manifest
    """
)
def checksum_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.checksum_chunks(documents_manifest(spark, folder))


@query(
    """
    SELECT name AS path, md5(content) AS md5, CAST(strlen(content) AS BIGINT) AS length FROM (
        SELECT source || '/' || doc_id || '.txt' AS name, text AS content FROM documents
        UNION ALL
        SELECT source || '/logs/' || doc_id || '/run.log',
               CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'doc ' || doc_id END
        FROM documents WHERE doc_id % 5 = 0)
    """
)
def md5_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in a file of its own and, deeper in the tree, the log of some, which may be empty."""
    path = fresh_path(spark, "files")
    documents = scan(spark, folder, "documents").select("doc_id", "text", "source")
    texts = documents.select(
        fn.join_path("source", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("name"),
        F.col("text").alias("content"),
    )
    line = F.concat(F.lit("doc "), F.col("doc_id").cast("string"))
    logs = documents.where("doc_id % 5 = 0").select(
        F.concat_ws("/", "source", F.lit("logs"), "doc_id", F.lit("run.log")).alias("name"),
        F.when(F.col("doc_id") % 3 == 0, "").otherwise(line).alias("content"),
    )
    writers.file_per_row(texts.unionByName(logs), path, "name", "content")
    files = manifest.manifest_build(spark, path)
    below = F.substr("path", F.locate("/", F.col("path")) + 1)
    return files.select(below.alias("path"), "md5", "length")


@query("SELECT s_name AS pool_name, CAST(s_suppkey % 20 AS INTEGER) AS slots FROM supplier")
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "pools")
    pools = scan(spark, folder, "supplier").select(
        F.col("s_name").alias("pool_name"), (F.col("s_suppkey") % 20).alias("slots")
    )
    writers.write_new(pools, path, "csv", header=True)
    return readers.csv_scan(spark, path, readers.POOLS)


@query("SELECT * FROM customer")
def json_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "customers")
    customer = scan(spark, folder, "customer")
    writers.json_sink(customer, path)
    return readers.json_scan(spark, path, customer.schema)


@query(
    """
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents
    """
)
def report_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written below each other into text files, each after a line with its id.

    The files are read in splits of any size and every line gets the id last seen above it.
    """
    path = fresh_path(spark, "reports")
    cell = F.concat(F.lit("Document Id: "), F.col("doc_id").cast("string"), F.lit("\n"), "text")
    scan(spark, folder, "documents").select(cell.alias("value")).write.text(path)
    lines = readers.split_line_scan(spark, path)
    doc_id = F.regexp_extract("line", r"^Document Id: (\d+)$", 1)
    marked = lines.withColumn("doc_id", F.nullif(doc_id, F.lit("")).cast("long"))
    filled = windows.carry_forward(marked, ["file"], "pos", ["doc_id"], block="block")
    return filled.where(doc_id == "").select("doc_id", "line")
