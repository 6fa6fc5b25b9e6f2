"""Inputs gathered per sample, outputs selected from workflow metadata, cohort lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators.aggregates import collect_values
from lanehouse.operators.filters import drop_null, require_unique
from lanehouse.sources import readers

# Fixed values
REQUIRED_OUTPUTS = [
    "ExomeGermlineSingleSample.output_bqsr_reports",
    "ExomeGermlineSingleSample.gvcf_summary_metrics",
    "ExomeGermlineSingleSample.output_cram_md5",
    "ExomeGermlineSingleSample.gvcf_detail_metrics",
    "ExomeGermlineSingleSample.hybrid_selection_metrics",
    "ExomeGermlineSingleSample.output_cram_index",
    "ExomeGermlineSingleSample.read_group_alignment_summary_metrics",
    "ExomeGermlineSingleSample.agg_quality_distribution_metrics",
    "ExomeGermlineSingleSample.agg_pre_adapter_detail_metrics",
    "ExomeGermlineSingleSample.output_cram",
    "ExomeGermlineSingleSample.agg_insert_size_metrics",
    "ExomeGermlineSingleSample.agg_alignment_summary_metrics",
    "ExomeGermlineSingleSample.output_vcf_index",
    "ExomeGermlineSingleSample.duplicate_metrics",
    "ExomeGermlineSingleSample.fingerprint_detail_metrics",
    "ExomeGermlineSingleSample.agg_bait_bias_summary_metrics",
    "ExomeGermlineSingleSample.agg_bait_bias_detail_metrics",
    "ExomeGermlineSingleSample.agg_insert_size_histogram_pdf",
    "ExomeGermlineSingleSample.output_vcf",
    "ExomeGermlineSingleSample.agg_error_summary_metrics",
    "ExomeGermlineSingleSample.fingerprint_summary_metrics",
    "ExomeGermlineSingleSample.agg_pre_adapter_summary_metrics",
    "ExomeGermlineSingleSample.validate_cram_file_report",
    "ExomeGermlineSingleSample.calculate_read_group_checksum_md5",
    "ExomeGermlineSingleSample.agg_quality_distribution_pdf",
]
GVCF_OUTPUT = "ExomeGermlineSingleSample.output_vcf"


def collect_inputs(rows: DataFrame, key: str, value: str) -> DataFrame:
    """The files of each sample, numbered from 1; entries without a sample or a file are left out."""
    return collect_values(drop_null(rows, [key, value]), [key], value)


def metadata_schema(required: Sequence[str] = tuple(REQUIRED_OUTPUTS)) -> str:
    """What is read of workflow metadata: the sample and the required outputs, each a field of its own.

    The JSON parser passes over all other outputs, however many and large they are.
    """
    fields = ", ".join(f"`{name}`: variant" for name in required)
    return f"{readers.WORKFLOW_INPUTS}, outputs struct<{fields}>"


def required_outputs(required: Sequence[str]) -> Column:
    """The required outputs of a document that are text, with their names; none where it has no outputs."""

    def entry(name: str) -> Column:
        return F.struct(F.lit(name).alias("output"), F.col("metadata.outputs").getField(name).alias("value"))

    # most outputs are not there: the type of a value is looked at only where there is one
    return F.filter(
        F.array(*map(entry, required)),
        lambda found: found["value"].isNotNull() & fn.is_string(found["value"]),
    )


def outputs_per_document(
    metadata: DataFrame, keep: Sequence[str], required: Sequence[str] = tuple(REQUIRED_OUTPUTS)
) -> DataFrame:
    """How many required outputs each document has, 0 included."""
    return metadata.select(*keep, F.size(required_outputs(required)).cast("long").alias("outputs"))


def select_outputs(
    metadata: DataFrame, keep: Sequence[str], required: Sequence[str] = tuple(REQUIRED_OUTPUTS)
) -> DataFrame:
    """Required text outputs of workflow metadata as rows with the sample and the base name.

    ``metadata`` has the column ``metadata``, read with ``metadata_schema`` of these outputs or more.
    Running it fails at a document without any, with the values of ``keep`` in the message. The check
    is part of the same pass.
    """
    sample = F.col("metadata.inputs.sample_and_unmapped_bams.sample_name").alias("sample_name")
    which = F.concat_ws(",", *(F.col(c).cast("string") for c in keep))
    nothing = F.raise_error(F.concat(F.lit("no required file found in document "), which))
    outputs = required_outputs(required)
    checked = F.transform(
        F.array(outputs), lambda found: F.when(F.size(found) > 0, found).otherwise(nothing)
    )[0]
    return metadata.select(*keep, sample, F.explode(checked).alias("_found")).select(
        *keep, "sample_name", "_found.output", fn.base_name(F.col("_found.value").cast("string")).alias("file")
    )


def build_cohort_list(entries: DataFrame, folder: str) -> DataFrame:
    """``(sample, gvcf)`` with the file's place below a common folder; a repeated sample fails the job.

    ``entries`` has the variant ``document``: a sample's outputs, or a list that starts with them.
    """
    first = fn.first_or_self("document")
    sample = F.try_variant_get(first, "$.sample_name", "string")
    gvcf = F.try_variant_get(first, f'$["{GVCF_OUTPUT}"]', "string")
    listed = entries.select(
        sample.alias("sample"),
        fn.join_path(F.lit(folder), sample, fn.base_name(gvcf)).alias("gvcf"),
    )
    return require_unique(listed, "sample", "more than one entry for a sample")
