"""Retention over ``orders`` as the run table and ``events`` and ``lineitem`` as aged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators.aggregates import last_per_group as last_of_group
from lanehouse.operators.filters import older_or_equal
from lanehouse.plans import retention
from lanehouse.session import fresh_path
from lanehouse.sources import dated
from lanehouse.sources.readers import scan
from lanehouse.workload.registry import query

CUTOFF = "2000-06-15 00:00:00"
LAST_SQL = """SELECT max(o_orderdate) AS last FROM orders
              WHERE (o_orderstatus = 'F') IS FALSE GROUP BY o_custkey"""
EXPIRED_SQL = f"o_orderdate <= TIMESTAMP '{CUTOFF}' AND o_orderdate NOT IN ({LAST_SQL})"


def cutoff():
    return F.lit(CUTOFF).cast("timestamp_ntz")


def runs(spark: SparkSession, folder: str) -> DataFrame:
    orders = scan(spark, folder, "orders")
    return orders.withColumn("external", F.col("o_orderstatus") == "F")


def kept(spark: SparkSession, folder: str) -> DataFrame:
    return retention.kept_instants(
        runs(spark, folder), "o_orderdate", [fn.is_false("external")], ["o_custkey"]
    )


@query(
    "SELECT o_custkey, max(o_orderdate) AS last FROM orders "
    "WHERE (o_orderstatus = 'F') IS FALSE GROUP BY o_custkey"
)
def last_per_group(spark: SparkSession, folder: str) -> DataFrame:
    return last_of_group(
        runs(spark, folder), "o_orderdate", [fn.is_false("external")], ["o_custkey"]
    )


@query(f"SELECT * FROM orders WHERE {EXPIRED_SQL}")
def retention_candidates(spark: SparkSession, folder: str) -> DataFrame:
    orders = scan(spark, folder, "orders")
    return retention.candidates(orders, "o_orderdate", cutoff(), kept(spark, folder))


@query(f"SELECT * FROM orders WHERE ({EXPIRED_SQL}) IS NOT TRUE")
def retention_survivors(spark: SparkSession, folder: str) -> DataFrame:
    orders = scan(spark, folder, "orders")
    return retention.survivors(orders, "o_orderdate", cutoff(), kept(spark, folder))


@query(
    """
    SELECT * FROM events
    WHERE ts > TIMESTAMP '2024-01-15 12:00:00'
       OR ts IN (SELECT max(ts) FROM events WHERE value > 90 GROUP BY user_id)
    """
)
def retention_in_place(spark: SparkSession, folder: str) -> DataFrame:
    """A table in a folder per day, of which aged days leave and mixed ones are written again."""
    path = fresh_path(spark, "events")
    events = scan(spark, folder, "events")
    last = retention.kept_instants(events, "ts", [F.col("value") > 90], ["user_id"])
    dated.write_dated(events, path, "ts")
    limit = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    dated.drop_aged(spark, path, events.schema, "ts", limit, last)
    return dated.read_dated(spark, path, events.schema).drop(dated.DAY)


@query(
    f"""
    SELECT 'orders' AS "table", count(*) AS n FROM orders WHERE {EXPIRED_SQL}
    UNION ALL SELECT 'events', count(*) FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00'
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_shipdate <= TIMESTAMP '{CUTOFF}'
    """
)
def retention_counts(spark: SparkSession, folder: str) -> DataFrame:
    events = scan(spark, folder, "events")
    lineitem = scan(spark, folder, "lineitem")
    now = F.lit("2024-02-14 12:00:00").cast("timestamp_ntz")
    limit = fn.cutoff(now, fn.age_or_default(F.lit(0)))
    return retention.delete_counts(
        orders=retention_candidates(spark, folder),
        events=older_or_equal(events, "ts", limit),
        lineitem=retention.candidates(lineitem, "l_shipdate", cutoff()),
    )


@query(
    """
    WITH r AS (SELECT o_custkey AS dag_id, o_orderdate AS execution_date,
                      o_orderstatus = 'F' AS external_trigger FROM orders),
    t AS (SELECT event_id, ts AS execution_date FROM events),
    l AS (SELECT l_partkey, l_shipdate, l_linestatus = 'O' AS still_open FROM lineitem)
    SELECT 'DagRun' AS "table", count(*) AS n FROM r
    WHERE execution_date <= TIMESTAMP '2000-12-01 00:00:00' AND execution_date NOT IN (
      SELECT max(execution_date) FROM r WHERE external_trigger IS FALSE GROUP BY dag_id)
    UNION ALL
    SELECT 'XCom', count(*) FROM t WHERE execution_date <= TIMESTAMP '2000-12-01 00:00:00'
    UNION ALL
    SELECT 'Delivery', count(*) FROM l
    WHERE l_shipdate <= TIMESTAMP '2000-12-01 00:00:00' AND l_shipdate NOT IN (
      SELECT max(l_shipdate) FROM l WHERE still_open IS FALSE GROUP BY l_partkey)
    """
)
def retention_plan(spark: SparkSession, folder: str) -> DataFrame:
    """The usual tables, and one with a rule of its own."""
    tables = {
        "DagRun": scan(spark, folder, "orders").select(
            F.col("o_custkey").alias("dag_id"),
            F.col("o_orderdate").alias("execution_date"),
            (F.col("o_orderstatus") == "F").alias("external_trigger"),
        ),
        "XCom": scan(spark, folder, "events").select(
            "event_id", F.col("ts").alias("execution_date")
        ),
        "Delivery": scan(spark, folder, "lineitem").select(
            "l_partkey", "l_shipdate", (F.col("l_linestatus") == "O").alias("still_open")
        ),
    }
    rule = retention.KeepLast("Delivery", "l_shipdate", ("still_open",), ("l_partkey",))
    specs = (*retention.AGED_TABLES, retention.AgedTable("Delivery", "l_shipdate", rule))
    now = F.lit("2000-12-31 00:00:00").cast("timestamp_ntz")
    plan = retention.retention_cleanup(tables, now, specs=specs)
    return retention.delete_counts(**{name: part.candidates() for name, part in plan.items()})


@query(
    f"""
    WITH stage AS (
      SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'notified' WHEN c_acctbal < 1000
             THEN 'candidate' WHEN c_acctbal < 2000 THEN 'deleted' ELSE 'active' END AS stage
      FROM customer),
    last AS (SELECT o_custkey AS c_custkey, max(o_orderdate) AS last_activity FROM orders GROUP BY 1)
    SELECT c_custkey, stage, last_activity,
           CASE WHEN last_activity > TIMESTAMP '{CUTOFF}' THEN stage
                WHEN stage = 'active' THEN 'candidate' WHEN stage = 'candidate' THEN 'notified'
                ELSE 'deleted' END AS next_stage
    FROM stage LEFT JOIN last USING (c_custkey)
    """
)
def project_cleanup(spark: SparkSession, folder: str) -> DataFrame:
    balance = F.col("c_acctbal")
    stage = (
        F.when(balance < 0, "notified")
        .when(balance < 1000, "candidate")
        .when(balance < 2000, "deleted")
        .otherwise("active")
    )
    projects = scan(spark, folder, "customer").select("c_custkey", stage.alias("stage"))
    activity = scan(spark, folder, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return retention.project_cleanup(projects, activity, "c_custkey", "o_orderdate", cutoff())
