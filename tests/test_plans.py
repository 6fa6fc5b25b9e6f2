"""Plans as a cluster would see them: with tables too large to broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from lanehouse.operators import filters, windows
from lanehouse.plans import capacity
from lanehouse.sources import readers
from lanehouse.workload import QUERIES

# they number rows in a whole order; the window adds up the row counts of the ranges
POSITIONS = {"chunks_exact", "checksum_chunks", "collect_inputs", "tool_order", "admin_summary"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_tables(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairing_of_all_rows_and_no_forced_broadcast(spark, sf_dir, large_tables, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BroadcastExchange" not in text
    assert "PythonUDF" not in text
    if "InPandas" in text:
        assert name in ("mapped_groups", "md5_files") and "FlatMapGroups" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_window_over_a_whole_table(spark, sf_dir, large_tables, name):
    """A window without a partition key appears only over the rows-per-range table."""
    text = plan(QUERIES[name](spark, sf_dir))
    alone = re.search(r"windowspecdefinition\((\S+ (ASC|DESC)|specifiedwindowframe)", text)
    assert bool(alone) == (name in POSITIONS)


def test_sheets_are_not_numbered_run_by_run(spark, sf_dir, large_tables):
    text = plan(QUERIES["sheet_index"](spark, sf_dir))
    assert "Window" not in text


def test_watermark_reaches_the_scan(spark, sf_dir):
    text = plan(QUERIES["sync_insert"](spark, sf_dir))
    assert re.search(r"PushedFilters: \[IsNotNull\(o_orderkey\), GreaterThan\(o_orderkey,Scal", text)


def test_cutoff_reaches_the_scan(spark, sf_dir):
    text = plan(QUERIES["retention_candidates"](spark, sf_dir))
    assert "LessThanOrEqual(o_orderdate" in text


def test_kept_runs_read_two_columns_and_the_filter(spark, sf_dir):
    text = plan(QUERIES["last_per_group"](spark, sf_dir))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in text


def test_groups_are_limited_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["top_slots"](spark, sf_dir))
    assert text.count("WindowGroupLimit") >= 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_capacity_limits_the_fold_before_the_shuffle(spark):
    states = spark.createDataFrame([], "cluster string, queue string, waiting long, active long, queued long")
    asked = capacity.requests(states, ["cluster", "queue"], 10)
    assert plan(capacity.total_steps(states, asked, ["cluster"], "queue", 70)).count("WindowGroupLimit") >= 2


def test_scan_of_files_without_content(spark, sf_dir):
    files = readers.file_scan(spark, sf_dir).select("path", "length")
    assert "content" not in plan(files).split("ReadSchema")[1]


def test_context_within_a_text_does_not_shuffle(spark, sf_dir):
    documents = readers.scan(spark, sf_dir, "documents")
    spots = documents.select("doc_id", F.inline(windows.context_of_text(F.col("text"), "the")))
    assert "Exchange" not in plan(spots)


def test_sections_of_texts_do_not_shuffle(spark, sf_dir):
    assert "Exchange" not in plan(QUERIES["text_sections"](spark, sf_dir))


def test_violations_are_one_pass(spark, sf_dir):
    documents = readers.scan(spark, sf_dir, "documents")
    rules = {"a": F.col("n_chars") > 10, "b": filters.required("lang")}
    text = plan(filters.violations(documents, ["doc_id"], rules))
    assert text.count("FileScan") == 1 and "Exchange" not in text
