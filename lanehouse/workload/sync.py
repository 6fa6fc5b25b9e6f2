"""Incremental sync: ``orders``, ``part`` and ``customer`` stand for the synced tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators.aggregates import max_or_zero
from lanehouse.operators.joins import update_tracked
from lanehouse.plans import sync
from lanehouse.session import fresh_path
from lanehouse.sources import keyed, writers
from lanehouse.sources.readers import scan
from lanehouse.workload.registry import query

COLUMNS = ("order_id", "customer_id", "status", "ordered", "priority")


def iso(column: str) -> Column:
    """A zone-less timestamp as ISO text, whatever the time zone of the session."""
    return F.replace(F.col(column).cast("string"), F.lit(" "), F.lit("T"))


def source_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as they arrive, the date as text."""
    text = F.concat(iso("o_orderdate"), F.lit(".000000Z"))
    return scan(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        text.alias("ordered"),
        F.col("o_orderpriority").alias("priority"),
    )


def target_orders(spark: SparkSession, folder: str) -> DataFrame:
    """What an earlier load left: keys below the mean, pending ones missing, statuses outdated."""
    orders = scan(spark, folder, "orders")
    earlier = F.col("o_orderkey") < orders.agg(F.avg("o_orderkey")).scalar()
    status = (
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("O"))
        .when(F.col("o_orderkey") % 11 == 0, F.lit(None))
        .otherwise(F.col("o_orderstatus"))
    )
    return orders.where(earlier & (F.col("o_orderstatus") != "P")).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("status"),
        F.col("o_orderdate").alias("ordered"),
        F.col("o_orderpriority").alias("priority"),
    )


SOURCE_SQL = """source AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
         o_orderdate AS ordered, o_orderpriority AS priority FROM orders)"""
TARGET_SQL = """target AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE WHEN o_orderkey % 7 = 0 THEN 'O' WHEN o_orderkey % 11 = 0 THEN NULL
              ELSE o_orderstatus END AS status,
         o_orderdate AS ordered, o_orderpriority AS priority
  FROM orders
  WHERE o_orderkey < (SELECT avg(o_orderkey) FROM orders) AND o_orderstatus <> 'P')"""
LOADED_SQL = """loaded AS (
  SELECT * FROM source
  WHERE order_id > (SELECT coalesce(max(order_id), 0) FROM target))"""
REFRESHED_SQL = """refreshed AS (
  SELECT t.order_id, t.customer_id,
         CASE WHEN t.status <> s.status THEN s.status ELSE t.status END AS status,
         t.ordered, t.priority
  FROM target t LEFT JOIN source s USING (order_id))"""


@query(f"WITH {SOURCE_SQL}, {TARGET_SQL}, {LOADED_SQL} SELECT * FROM loaded")
def sync_insert(spark: SparkSession, folder: str) -> DataFrame:
    return sync.new_rows(
        source_orders(spark, folder),
        target_orders(spark, folder),
        "order_id",
        COLUMNS,
        ["ordered"],
    )


@query(f"WITH {SOURCE_SQL} SELECT * FROM source WHERE order_id > 0")
def sync_insert_empty(spark: SparkSession, folder: str) -> DataFrame:
    empty = target_orders(spark, folder).where(F.col("status") == "not a status")
    return sync.new_rows(source_orders(spark, folder), empty, "order_id", COLUMNS, ["ordered"])


@query(f"WITH {SOURCE_SQL}, {TARGET_SQL}, {REFRESHED_SQL} SELECT * FROM refreshed")
def sync_update(spark: SparkSession, folder: str) -> DataFrame:
    return update_tracked(
        target_orders(spark, folder), source_orders(spark, folder), "order_id", "status"
    )


@query(
    f"WITH {SOURCE_SQL}, {TARGET_SQL}, {LOADED_SQL}, {REFRESHED_SQL} "
    "SELECT * FROM refreshed UNION ALL SELECT * FROM loaded"
)
def sync_full(spark: SparkSession, folder: str) -> DataFrame:
    return sync.incremental_sync(
        source_orders(spark, folder),
        target_orders(spark, folder),
        "order_id",
        COLUMNS,
        ["ordered"],
        "status",
    )


@query(f"WITH {TARGET_SQL} SELECT coalesce(max(order_id), 0) AS order_id FROM target")
def watermark(spark: SparkSession, folder: str) -> DataFrame:
    return max_or_zero(target_orders(spark, folder), "order_id")


def as_table(df: DataFrame, table: sync.SyncedTable, *values: Column) -> DataFrame:
    """``values`` under the names of the table's columns."""
    return df.select(*(v.alias(name) for name, v in zip(table.columns, values, strict=True)))


def as_project(orders: DataFrame, status: Column) -> DataFrame:
    return as_table(
        orders,
        sync.PROJECT,
        F.col("o_orderkey"),
        F.format_string("P%06d", "o_orderkey"),
        F.format_string("project_%d", "o_custkey"),
        F.concat(iso("o_orderdate"), F.lit(".000000Z")),
        F.lit(None).cast("string"),
        status,
        F.col("o_orderpriority"),
    )


@query(
    f"""
    WITH source AS (
      SELECT o_orderkey AS project_id, printf('P%06d', o_orderkey) AS {sync.PROJECT.columns[1]},
             'project_' || o_custkey AS project_name, o_orderdate AS start_timestamp,
             CAST(NULL AS VARCHAR) AS description, o_orderstatus AS status,
             o_orderpriority AS deliverable
      FROM orders),
    target AS (
      SELECT * REPLACE (CASE WHEN status = 'P' THEN 'O' ELSE status END AS status)
      FROM source WHERE project_id < (SELECT avg(project_id) FROM source))
    SELECT t.* REPLACE (CASE WHEN t.status <> s.status THEN s.status ELSE t.status END AS status)
    FROM target t JOIN source s USING (project_id)
    UNION ALL
    SELECT * FROM source WHERE project_id > (SELECT coalesce(max(project_id), 0) FROM target)
    """
)
def sync_projects(spark: SparkSession, folder: str) -> DataFrame:
    orders = scan(spark, folder, "orders")
    earlier = F.col("o_orderkey") < orders.agg(F.avg("o_orderkey")).scalar()
    outdated = F.when(F.col("o_orderstatus") == "P", "O").otherwise(F.col("o_orderstatus"))
    target = as_project(orders.where(earlier), outdated).withColumn(
        "start_timestamp", fn.normalise_ts("start_timestamp")
    )
    return sync.sync_table(sync.PROJECT, as_project(orders, F.col("o_orderstatus")), target)


@query(
    f"""
    WITH source AS (
      SELECT o_orderkey AS project_id, printf('P%06d', o_orderkey) AS {sync.PROJECT.columns[1]},
             'project_' || o_custkey AS project_name, o_orderdate AS start_timestamp,
             CAST(NULL AS VARCHAR) AS description,
             CASE WHEN o_orderkey % 1000 < 50 THEN 'O' ELSE o_orderstatus END AS status,
             o_orderpriority AS deliverable
      FROM orders),
    known AS (SELECT * FROM source WHERE project_id < (SELECT avg(project_id) FROM source))
    SELECT *, CAST(floor(project_id / 200) AS BIGINT) AS key_range FROM known
    UNION ALL
    SELECT *, CAST(floor(project_id / 200) AS BIGINT) FROM source
    WHERE project_id > (SELECT max(project_id) FROM known)
    """
)
def sync_in_place(spark: SparkSession, folder: str) -> DataFrame:
    """A table in ranges of 200 keys, of which changes touch one in five."""
    path = fresh_path(spark, "projects")
    orders = scan(spark, folder, "orders")
    renewed = F.when(F.col("o_orderkey") % 1000 < 50, "O").otherwise(F.col("o_orderstatus"))
    target = as_project(
        orders.where(F.col("o_orderkey") < orders.agg(F.avg("o_orderkey")).scalar()), F.col("o_orderstatus")
    ).withColumn("start_timestamp", fn.normalise_ts("start_timestamp"))
    keyed.write_keyed(target, path, "project_id", 200)
    sync.sync_in_place(sync.PROJECT, as_project(orders, renewed), path, target.schema, 200)
    return keyed.read_keyed(spark, path, target.schema)


@query(
    """
    WITH source AS (
      SELECT p_partkey AS pipeline_id, p_name AS pipeline_name, p_brand AS pipeline_db,
             p_type AS pipeline_type, CASE WHEN p_size > 25 THEN 'Y' ELSE 'N' END AS is_active,
             TIMESTAMP '2024-01-01 00:00:00' + to_days(p_size) AS date_stamp
      FROM part),
    target AS (
      SELECT * REPLACE ('Y' AS is_active)
      FROM source WHERE pipeline_id < (SELECT avg(pipeline_id) FROM source))
    SELECT t.* REPLACE (s.is_active AS is_active)
    FROM target t JOIN source s USING (pipeline_id)
    UNION ALL
    SELECT * FROM source WHERE pipeline_id > (SELECT coalesce(max(pipeline_id), 0) FROM target)
    """
)
def sync_active_flags(spark: SparkSession, folder: str) -> DataFrame:
    part = scan(spark, folder, "part")
    stamp = F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size"))
    source = part.select(
        F.col("p_partkey").alias("pipeline_id"),
        F.col("p_name").alias("pipeline_name"),
        F.col("p_brand").alias("pipeline_db"),
        F.col("p_type").alias("pipeline_type"),
        F.when(F.col("p_size") > 25, "Y").otherwise("N").alias("is_active"),
        F.concat(stamp.cast("string"), F.lit("T00:00:00.000000Z")).alias("date_stamp"),
    )
    target = (
        source.where(F.col("pipeline_id") < source.agg(F.avg("pipeline_id")).scalar())
        .withColumn("is_active", F.lit("Y"))
        .withColumn("date_stamp", fn.normalise_ts("date_stamp"))
    )
    return sync.sync_table(sync.PIPELINE, source, target)


@query(
    f"""
    WITH source AS (
      SELECT c_custkey AS user_id, 'U' || c_custkey AS {sync.USER.columns[1]}, c_name AS name,
             lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) AS email_id,
             CASE WHEN c_acctbal < 0 THEN 'BLOCKED' ELSE 'ACTIVE' END AS status
      FROM customer),
    target AS (
      SELECT * REPLACE ('ACTIVE' AS status)
      FROM source WHERE user_id < (SELECT avg(user_id) FROM source))
    SELECT t.* REPLACE (s.status AS status) FROM target t JOIN source s USING (user_id)
    UNION ALL
    SELECT * FROM source WHERE user_id > (SELECT coalesce(max(user_id), 0) FROM target)
    """
)
def sync_users(spark: SparkSession, folder: str) -> DataFrame:
    customer = scan(spark, folder, "customer")
    address = F.concat(
        F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@"), F.lower("c_mktsegment")
    )
    source = as_table(
        customer,
        sync.USER,
        F.col("c_custkey"),
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")),
        F.col("c_name"),
        address,
        F.when(F.col("c_acctbal") < 0, "BLOCKED").otherwise("ACTIVE"),
    )
    target = source.where(F.col("user_id") < source.agg(F.avg("user_id")).scalar()).withColumn(
        "status", F.lit("ACTIVE")
    )
    return sync.sync_table(sync.USER, source, target)


@query(
    """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS ordered
    FROM orders
    """
)
def ts_normalise(spark: SparkSession, folder: str) -> DataFrame:
    plain = iso("o_orderdate")
    text = (
        F.when(F.col("o_orderkey") % 13 == 0, F.concat(F.lit("about "), plain))
        .when(F.col("o_orderkey") % 3 == 0, plain)
        .otherwise(F.concat(plain, F.lit(".000000Z")))
    )
    return scan(spark, folder, "orders").select(
        "o_orderkey", fn.normalise_ts(text).alias("ordered")
    )


@query("SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_acctbal < 0")
def snapshot_replace(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "snapshot")
    customer = scan(spark, folder, "customer")
    writers.snapshot_replace(customer.where("c_acctbal >= 0"), path)
    writers.snapshot_replace(customer, path)
    writers.append(customer.where("c_acctbal < 0"), path)
    return spark.read.schema(customer.schema).parquet(path)


@query("SELECT *, '2024-01-02' AS snapshot_date FROM supplier UNION ALL "
       "SELECT *, '2024-01-03' AS snapshot_date FROM supplier WHERE s_acctbal >= 0")
def snapshot_backup(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "backup")
    supplier = scan(spark, folder, "supplier")
    writers.snapshot_backup(supplier.where("s_acctbal < 0"), path, "2024-01-01")
    writers.snapshot_backup(supplier.where("s_acctbal < 0"), path, "2024-01-02")
    writers.snapshot_backup(supplier, path, "2024-01-02")
    writers.snapshot_backup(supplier.where("s_acctbal >= 0"), path, "2024-01-03")
    backups = spark.read.parquet(path).withColumn(
        "snapshot_date", F.col("snapshot_date").cast("string")
    )
    return writers.newest_snapshots(backups, 2)


@query(
    """
    SELECT 'nation' AS "table", CAST(to_json(nation) AS VARCHAR) AS "row" FROM nation
    UNION ALL
    SELECT 'part', CAST(to_json(part) AS VARCHAR) FROM part
    """
)
def metadata_dump(spark: SparkSession, folder: str) -> DataFrame:
    return writers.metadata_dump(nation=scan(spark, folder, "nation"), part=scan(spark, folder, "part"))
