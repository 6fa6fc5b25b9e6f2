"""From raw documents to packed training sequences, in stages that each read what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.llm import decontamination, line_dedup, near_dedup, quality
from lanehouse.llm.frames import keep
from lanehouse.llm.queries import packed
from lanehouse.sources.readers import scan

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: the columns of documents, which all stages but the last return
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among ``docs``.

    Without any label all documents are accepted.
    """
    model = quality.learn(docs, scan(spark, sf_dir, "labels"))
    return quality.accepted(docs.select(*COLUMNS), model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the boilerplate lines of their source; ``n_chars`` is counted anew.

    NULL text becomes empty, as ``line_dedup.drop_boilerplate`` has it.
    """
    cleaned = line_dedup.drop_boilerplate(docs.select(*COLUMNS), "source")
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id."""
    return near_dedup.first_of_class(docs.select(*COLUMNS))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Items are searched in what the stages before have left: lines that ``drop_lines`` took from a text are
    not looked at, and of near copies only the one that stays is.
    """
    return decontamination.without_leaks(docs.select(*COLUMNS), scan(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, each with its place in a sequence."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_lines),
    ("near_dedup", keep_first),
    ("decontamination", keep_clean),
    ("best_fit_packing", pack),
]

#: trained models and checksums of tokens have no SQL form; the stages are tested against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents in ``sf_dir``."""
    docs = scan(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
