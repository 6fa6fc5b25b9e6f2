"""A third of the rows under one key, and thresholds so low that AQE has to split it."""

import pytest
from pyspark.sql import functions as F

from lanehouse.operators import aggregates, joins
from lanehouse.plans import capacity, retention, status

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}
ROWS = 90_000


@pytest.fixture
def skew_settings(spark):
    before = {key: spark.conf.get(key) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def hot(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k")
    text = F.sha2(F.col("id").cast("string"), 256).alias("v")
    return spark.range(0, ROWS, 1, 8).select(key, text, F.lit("SEEDED").alias("status"))


def rows_and_plan(df):
    """The number of rows, read through all columns, and the final plan."""
    counted = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*df.columns)))
    n = counted.collect()[0].n
    return n, counted._jdf.queryExecution().executedPlan().toString()


def check(df, expected):
    n, plan = rows_and_plan(df)
    assert n == expected
    assert "skew=true" in plan


def test_status_transition(spark, skew_settings):
    ids = spark.range(500).select(F.col("id").alias("k"))
    check(status.apply_transition(hot(spark), ids, "k", "status", status.ANALYSIS_RUNNING), ROWS)


def test_unknown(spark, skew_settings):
    known = spark.range(1, 6).select(F.col("id").alias("k"))
    left = hot(spark).where("k BETWEEN 1 AND 5").count()
    check(joins.unknown(hot(spark), known, "k"), ROWS - left)


def test_match_ids(spark, skew_settings):
    check(joins.match_ids(hot(spark), spark.range(900).select(F.col("id").alias("k")), "k"), ROWS)


def test_attach_reports(spark, skew_settings):
    groups = spark.range(1010).select(F.col("id").alias("k"))
    alone = 1010 - hot(spark).select("k").distinct().count()
    check(joins.attach_reports(groups, hot(spark), ["k"]), ROWS + alone)


def retention_tables(spark):
    at = F.timestamp_seconds("k").cast("timestamp_ntz").alias("at")
    table = hot(spark).select(at, "v")
    kept = table.where("second(at) = 1").select(F.col("at").alias("last"))
    return table, kept, F.lit("2030-01-01").cast("timestamp_ntz")


def test_retention(spark, skew_settings):
    table, kept, cutoff = retention_tables(spark)
    stay = table.where("second(at) = 1").count()
    check(retention.candidates(table, "at", cutoff, kept), ROWS - stay)
    check(retention.survivors(table, "at", cutoff, kept), stay)


def test_positions_within_a_key(spark, skew_settings):
    check(aggregates.collect_values(hot(spark), ["k"], "v"), ROWS)


def test_capacity(spark, skew_settings):
    cluster = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 900))
    queues = spark.range(0, ROWS, 1, 8).select(
        cluster.alias("cluster"), F.sha2(F.col("id").cast("string"), 256).alias("queue")
    )
    waiting = queues.withColumn("waiting", F.lit(1))
    active = queues.select("cluster", "queue", F.lit("F").alias("state"), F.lit(1).alias("n"))
    check(capacity.capacity_plan(waiting, active), ROWS)


def test_idle_workers(spark, skew_settings):
    queue = F.when(F.col("id") % 3 == 0, "hpc_hot").otherwise(F.concat(F.lit("q"), F.col("id") % 900))
    workers = spark.range(0, ROWS, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("worker_id"),
        F.lit(0).alias("active_jobs"),
        F.array(queue).alias("queues"),
    )
    needed = spark.createDataFrame([("hpc_hot",)], "queue string")
    check(capacity.idle_workers(workers, needed), ROWS - ROWS // 3)
