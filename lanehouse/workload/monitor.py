"""Storage, replication and admin summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.operators import aggregates
from lanehouse.plans import monitor
from lanehouse.sources.readers import scan
from lanehouse.workload.registry import query

DISK_SQL = """disk AS (
  SELECT n_name AS host, CAST(floor(abs(c_acctbal)) AS BIGINT) AS used, c_custkey AS avail
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE c_custkey % 3 <> 2)"""
QUOTA_SQL = """quota AS (
  SELECT n_name AS host, s_suppkey AS used, CAST(floor(abs(s_acctbal)) AS BIGINT) AS avail
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def on_host(df: DataFrame, nationkey: str, spark: SparkSession, folder: str) -> DataFrame:
    nation = scan(spark, folder, "nation").select(
        "n_nationkey", F.col("n_name").alias("host")
    )
    return df.join(nation, F.col(nationkey) == F.col("n_nationkey"))


def whole(column: str) -> Column:
    return F.floor(F.abs(F.col(column)))


def disk_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Disk report lines: one per customer, two thirds of them of the data volumes."""
    volume = F.when(F.col("c_custkey") % 3 == 2, "/dev/sda1").otherwise("/dev/mapper/datavol")
    line = F.format_string(
        "%s  %d %d   %d %d%% /mnt/%d",
        volume,
        whole("c_acctbal") + F.col("c_custkey"),
        whole("c_acctbal"),
        F.col("c_custkey"),
        F.col("c_custkey") % 100,
        F.col("c_custkey"),
    )
    return on_host(scan(spark, folder, "customer"), "c_nationkey", spark, folder).select(
        "host", line.alias("line")
    )


def quota_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Quota reports: a share's name, then its live line with single spaces."""
    text = F.format_string(
        "share archive-2018\nLive a b c d e f g h i j k 1 l 2\n"
        "share archive-2019\nLive a b c d e f g h i j k %d l %d\nProjected x\n",
        F.col("s_suppkey"),
        whole("s_acctbal") + F.col("s_suppkey"),
    )
    return on_host(scan(spark, folder, "supplier"), "s_nationkey", spark, folder).select(
        "host", text.alias("text")
    )


@query(
    f"""
    WITH {DISK_SQL}, {QUOTA_SQL}, both_kinds AS (SELECT * FROM disk UNION ALL SELECT * FROM quota)
    SELECT host, CAST(sum(used) AS BIGINT) AS used, CAST(sum(avail) AS BIGINT) AS avail,
           CASE WHEN sum(used) + sum(avail) > 0
                THEN round(CAST(sum(used) AS DOUBLE) / CAST(sum(used) + sum(avail) AS DOUBLE), 6)
                ELSE 0.0 END AS used_share
    FROM both_kinds GROUP BY host
    """
)
def storage_report(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.storage_report(
        monitor.disk_usage(disk_lines(spark, folder), "datavol"),
        monitor.quota_usage(quota_texts(spark, folder), "archive-2019"),
    )


STATUS_SQL = """status AS (
  SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
         CASE event_type WHEN 'purchase' THEN 'ON' WHEN 'click' THEN 'CONNECTING' WHEN 'view' THEN NULL
              ELSE 'OFF' END AS state FROM events)"""


def replication_status(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    state = (
        F.when(kind == "purchase", "ON")
        .when(kind == "click", "CONNECTING")
        .when(kind == "view", F.lit(None))
        .otherwise("OFF")
    )
    day = F.col("ts").cast("date").cast("string")
    return scan(spark, folder, "events").select("user_id", day.alias("day"), state.alias("state"))


@query(
    f"""
    WITH {STATUS_SQL}
    SELECT user_id, day, coalesce(bool_or(contains(state, 'ON')), false) AS healthy
    FROM status GROUP BY ALL
    """
)
def replication_health(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.replication_health(
        replication_status(spark, folder), ["user_id", "day"], "state"
    )


@query(
    f"""
    WITH {STATUS_SQL}
    SELECT user_id, day FROM status GROUP BY ALL
    HAVING NOT coalesce(bool_or(contains(state, 'ON')), false)
    """
)
def failing_servers(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.failing_servers(
        replication_status(spark, folder), ["user_id", "day"], "state"
    )


@query(
    """
    SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority, count(*) AS runs
    FROM orders GROUP BY ALL
    """
)
def run_counts(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.run_counts(scan(spark, folder, "orders"), "o_orderdate", "o_orderpriority")


SUMMARY_SQL = f"""{DISK_SQL},
p AS (SELECT '{{"o_orderpriority":"' || o_orderpriority || '","o_orderstatus":"' || o_orderstatus
             || '","runs":' || count(*) || '}}' AS j FROM orders GROUP BY o_orderpriority, o_orderstatus),
r AS (SELECT '{{"month":"' || strftime(ts, '%Y-%m') || '","event_type":"' || event_type
             || '","runs":' || count(*) || '}}' AS j FROM events GROUP BY strftime(ts, '%Y-%m'), event_type),
totals AS (SELECT host, CAST(sum(used) AS BIGINT) AS used, CAST(sum(avail) AS BIGINT) AS avail
           FROM disk GROUP BY host),
s AS (SELECT '{{"host":"' || host || '","used":' || used || ',"avail":' || avail || ',"used_share":'
             || CASE WHEN used + avail > 0 THEN round(CAST(used AS DOUBLE) / CAST(used + avail AS DOUBLE), 6)
                     ELSE 0.0 END || '}}' AS j FROM totals),
sections AS (SELECT 'pipelines' AS section, j AS "row" FROM p UNION ALL SELECT 'seqruns', j FROM r
             UNION ALL SELECT 'storage', j FROM s)"""


@query(
    f"""
    WITH {SUMMARY_SQL}
    SELECT section, row_number() OVER (PARTITION BY section ORDER BY "row") AS position, "row" FROM sections
    """
)
def admin_summary(spark: SparkSession, folder: str) -> DataFrame:
    orders = scan(spark, folder, "orders")
    return monitor.admin_summary(
        runs=scan(spark, folder, "events"),
        ts="ts",
        kind="event_type",
        usage=monitor.disk_usage(disk_lines(spark, folder), "datavol"),
        pipelines=orders,
        pipeline="o_orderpriority",
        status="o_orderstatus",
    )


@query(
    f"""
    WITH {DISK_SQL}
    SELECT '{{"orders":{{"rows":' || (SELECT count(*) FROM orders) || '}},"storage":{{"rows":' || count(*)
           || ',"used":' || CAST(sum(used) AS BIGINT) || ',"avail":' || CAST(sum(avail) AS BIGINT) || '}}}}'
           AS document
    FROM disk
    """
)
def summary_totals(spark: SparkSession, folder: str) -> DataFrame:
    usage = monitor.disk_usage(disk_lines(spark, folder), "datavol")
    return monitor.summary_totals(
        orders=(scan(spark, folder, "orders"), ()), storage=(usage, ("used", "avail"))
    )
