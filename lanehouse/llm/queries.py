"""The registered queries of these operators, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.llm import (
    decontamination,
    fingerprints,
    id_files,
    languages,
    line_dedup,
    lm_scores,
    near_dedup,
    packing,
    periodic_runs,
    prefix_trie,
    quality,
    secrets,
    token_counts,
)
from lanehouse.sources.readers import scan

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SEQUENCE_TOKENS = 2048
#: the id that ends a document in the files of op13
END_ID = 1


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def tokenizer(name: str) -> str:
    from public_tokenizers import path

    return path(name)


@query()
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.fingerprints(scan(spark, sf_dir, "documents"))
    return found.withColumns(
        {"n_removed": F.size("edited_removed"), "n_added": F.size("edited_added")}
    ).drop("edited_removed", "edited_added")


@query()
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(scan(spark, sf_dir, "documents"))


@query(
    """
    WITH pages AS (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    on_page AS (
        SELECT source, unnest(list_distinct(list_filter(
            list_transform(lines, lambda x: trim(x)), lambda x: x <> ''))) AS line
        FROM pages),
    counted AS (SELECT source, line, count(*) AS n FROM on_page GROUP BY ALL),
    totals AS (SELECT source, count(*) AS n_pages FROM documents GROUP BY ALL),
    gone AS (
        SELECT counted.source, list(line) AS drop_lines
        FROM counted JOIN totals ON counted.source IS NOT DISTINCT FROM totals.source
        WHERE n >= 2 AND n > 0.1 * n_pages GROUP BY ALL),
    kept AS (
        SELECT doc_id, lines, CASE WHEN drop_lines IS NULL THEN lines ELSE list_filter(
            lines, lambda x: NOT list_contains(drop_lines, trim(x))) END AS left_lines
        FROM pages LEFT JOIN gone ON pages.source IS NOT DISTINCT FROM gone.source)
    SELECT doc_id, CAST(len(lines) AS INTEGER) AS n_lines,
        CAST(len(lines) - len(left_lines) AS INTEGER) AS n_dropped, array_to_string(left_lines, chr(10)) AS text
    FROM kept
    """
)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(scan(spark, sf_dir, "documents"), "source")
    return cleaned.select("doc_id", "n_lines", "n_dropped", "text")


@query()
def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.score_texts(scan(spark, sf_dir, "documents"))


@query()
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(scan(spark, sf_dir, "documents"))
    base, spans = secrets.spans_text(F.col("base_spans")), secrets.spans_text(F.col("spans"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(base, 256).alias("base_sha256"), spans.alias("spans")
    )


@query()
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents")
    return quality.score(docs, quality.learn(docs, scan(spark, sf_dir, "labels")))


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` in sequences, by the parameters of op7."""
    json, ranks = tokenizer("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.tiktoken")
    return packing.pack_documents(docs, json, SEQUENCE_TOKENS, ranks_path=ranks)


@query()
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(scan(spark, sf_dir, "documents"))


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.language_id(scan(spark, sf_dir, "documents"))


@query()
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(scan(spark, sf_dir, "documents"), scan(spark, sf_dir, "benchmark"))


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, tokenizer("byte_bpe_50k.json"), 1024)


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_repeats(scan(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.find_runs(docs))


@query()
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prefix_trie.sequences(scan(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.branched(rows))


@query()
def op13_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = id_files.id_folder(spark)
    docs = scan(spark, sf_dir, "documents")
    files = id_files.write_ids(docs, tokenizer("word_bpe_49k.json"), folder, END_ID)
    read = id_files.read_ids(files, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
