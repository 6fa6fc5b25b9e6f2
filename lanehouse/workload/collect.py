"""Inputs, outputs and cohort lists, and functions mapped over groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators import filters, sets
from lanehouse.plans import collect
from lanehouse.session import fresh_path
from lanehouse.sources import readers, writers
from lanehouse.sources.readers import scan
from lanehouse.workload.registry import query

INPUTS_SQL = """inputs AS (
  SELECT l_orderkey AS sample, 'part' || l_partkey || '.' || l_linenumber || '.bam' AS bam
  FROM lineitem WHERE l_quantity >= 5 AND l_returnflag <> 'N')"""


def inputs(spark: SparkSession, folder: str) -> DataFrame:
    """A file per line; some lines have no file, and some no sample."""
    bam = F.concat_ws(".", F.concat(F.lit("part"), "l_partkey"), "l_linenumber", F.lit("bam"))
    return scan(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") != "N", F.col("l_orderkey")).alias("sample"),
        F.when(F.col("l_quantity") >= 5, bam).alias("bam"),
    )


@query(
    f"""
    WITH {INPUTS_SQL}
    SELECT sample, row_number() OVER (PARTITION BY sample ORDER BY bam) AS position, bam FROM inputs
    """
)
def collect_inputs(spark: SparkSession, folder: str) -> DataFrame:
    return collect.collect_inputs(inputs(spark, folder), "sample", "bam")


@query(
    """
    SELECT '{"sample_name":"s' || doc_id || '","unmapped_bams":'
           || CAST(to_json(string_split(text, chr(10))) AS VARCHAR) || '}' AS document
    FROM documents
    """
)
def input_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Lists that arrive in one row: the lines of a document."""
    name = F.concat(F.lit("s"), F.col("doc_id").cast("string"))
    documents = scan(spark, folder, "documents")
    return documents.select(fn.input_json(name, fn.text_lines("text")).alias("document"))


OUTPUT_VCF = "ExomeGermlineSingleSample.output_vcf"
OUTPUT_CRAM = "ExomeGermlineSingleSample.output_cram"
OUTPUT_MD5 = "ExomeGermlineSingleSample.output_cram_md5"


def workflow_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Workflow metadata as JSON: paths, a number, a null and an output nobody asked for."""
    vcf = F.when(
        F.col("event_type") == "view", F.format_string('"%s":null,', F.lit(OUTPUT_VCF))
    ).otherwise(F.format_string('"%s":"/work/%d/s.vcf.gz",', F.lit(OUTPUT_VCF), F.col("event_id")))
    cram = F.when(
        F.col("event_type") == "click", F.format_string('"%s":17,', F.lit(OUTPUT_CRAM))
    ).otherwise(
        F.format_string('"%s":"/work/%d.cram",', F.lit(OUTPUT_CRAM), F.col("event_id"))
    )
    document = F.concat(
        F.format_string(
            '{"inputs":{"sample_and_unmapped_bams":{"sample_name":"s%d"}},"outputs":{',
            F.col("user_id"),
        ),
        vcf,
        cram,
        F.format_string('"%s":["/work/a.md5"],"other":"/work/other.txt"}}', F.lit(OUTPUT_MD5)),
    )
    return scan(spark, folder, "events").select(
        "event_id", fn.parse_json(document, collect.metadata_schema()).alias("metadata")
    )


@query(
    f"""
    SELECT event_id, 's' || user_id AS sample_name, '{OUTPUT_VCF}' AS output, 's.vcf.gz' AS file
    FROM events WHERE event_type <> 'view'
    UNION ALL
    SELECT event_id, 's' || user_id, '{OUTPUT_CRAM}', event_id || '.cram'
    FROM events WHERE event_type <> 'click'
    """
)
def select_outputs(spark: SparkSession, folder: str) -> DataFrame:
    return collect.select_outputs(workflow_documents(spark, folder), ["event_id"])


@query("SELECT event_id, CASE WHEN event_type = 'view' THEN 0 ELSE 1 END::BIGINT AS outputs FROM events")
def outputs_per_document(spark: SparkSession, folder: str) -> DataFrame:
    return collect.outputs_per_document(
        workflow_documents(spark, folder), ["event_id"], [OUTPUT_VCF, OUTPUT_MD5]
    )


COHORT_SQL = """SELECT 's' || event_id AS sample,
       '/cohort/s' || event_id || '/' || event_id || '.g.vcf' AS gvcf FROM events"""


def cohort(spark: SparkSession, folder: str) -> DataFrame:
    """Sample documents, every other one inside a list."""
    document = F.format_string(
        '{"sample_name":"s%d","%s":"/run/%d.g.vcf"}',
        F.col("event_id"), F.lit(collect.GVCF_OUTPUT), F.col("event_id"),
    )
    listed = F.when(F.col("event_id") % 2 == 0, document).otherwise(
        F.concat(F.lit("["), document, F.lit(',{"sample_name":"later"}]'))
    )
    entries = scan(spark, folder, "events").select(F.parse_json(listed).alias("document"))
    return collect.build_cohort_list(entries, "/cohort")


@query(COHORT_SQL)
def cohort_list(spark: SparkSession, folder: str) -> DataFrame:
    return cohort(spark, folder)


@query(COHORT_SQL)
def cohort_tsv(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "cohort")
    writers.tsv_sink(cohort(spark, folder), path)
    return spark.read.schema("sample string, gvcf string").csv(path, sep="\t")


@query(
    """
    SELECT source, count(*) AS documents,
           count(*) FILTER (n_chars > 1000) AS long_documents
    FROM documents GROUP BY source
    """
)
def mapped_groups(spark: SparkSession, folder: str) -> DataFrame:
    def count_long(frame: pd.DataFrame, limit: int) -> pd.DataFrame:
        long_ones = int((frame["n_chars"] > limit).sum())
        row = {"source": frame["source"].iloc[0], "documents": len(frame), "long_documents": long_ones}
        return pd.DataFrame([row])

    documents = scan(spark, folder, "documents").select("source", "n_chars")
    return sets.map_groups(
        documents,
        ["source"],
        count_long,
        "source string, documents long, long_documents long",
        merge=[F.sum(c).alias(c) for c in ("documents", "long_documents")],
        limit=1000,
    )


@query(
    """
    SELECT user_id, unnest([event_type, 'x' || user_id]) AS slide FROM events
    """
)
def flat_slides(spark: SparkSession, folder: str) -> DataFrame:
    other = F.concat(F.lit("x"), F.col("user_id").cast("string"))
    runs = scan(spark, folder, "events").select(
        "user_id", F.array("event_type", other).alias("slides")
    )
    return sets.flatten_groups(runs, "slides", "slide")


@query("SELECT event_id, user_id, value FROM events WHERE value > 5")
def required_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = scan(spark, folder, "events").select("event_id", "user_id", "value")
    return filters.require_rows(events.where("value > 5"), "no event above 5")


@query(
    """
    WITH steps AS (
        SELECT hour(ts) AS hour, ts, event_id,
               sum(CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN -1 ELSE 0 END)
                 OVER (PARTITION BY hour(ts) ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS level
        FROM events),
    waits AS (
        SELECT *, level - least(0, min(level) OVER (PARTITION BY hour ORDER BY ts, event_id
                                                    ROWS UNBOUNDED PRECEDING)) AS waiting
        FROM steps)
    SELECT CAST(hour AS INTEGER) AS hour, count(*) AS steps, CAST(max(waiting) AS BIGINT) AS most,
           CAST(arg_max(waiting, struct_pack(ts := ts, event_id := event_id)) AS BIGINT) AS at_end
    FROM waits GROUP BY hour
    """
)
def queue_backlog(spark: SparkSession, folder: str) -> DataFrame:
    """Tasks that wait, step by step, where a worker that finds none leaves the count at zero."""

    def follow(batches: Iterator[pa.RecordBatch], floor: int) -> Iterator[pa.RecordBatch]:
        hour, steps, most, waiting = None, 0, floor, floor
        for batch in batches:
            hour, steps = batch.column("hour")[0].as_py(), steps + batch.num_rows
            level = waiting + np.cumsum(batch.column("delta").to_numpy())
            level -= np.minimum(np.minimum.accumulate(level) - floor, 0)
            most, waiting = max(most, int(level.max())), int(level[-1])
        yield pa.RecordBatch.from_pylist(
            [{"hour": hour, "steps": steps, "most": most, "at_end": waiting}],
            pa.schema([("hour", pa.int32()), *((c, pa.int64()) for c in ("steps", "most", "at_end"))]),
        )

    kind = F.col("event_type")
    delta = F.when(kind == "signup", 1).when(kind == "purchase", -1).otherwise(0)
    steps = scan(spark, folder, "events").select(
        F.hour("ts").alias("hour"), "ts", "event_id", delta.cast("long").alias("delta")
    )
    schema = "hour int, steps long, most long, at_end long"
    return sets.map_whole_groups(steps, ["hour"], ["ts", "event_id"], follow, schema, floor=0)
