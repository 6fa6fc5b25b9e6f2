"""Queues, workers and capacity over ``events``: a user is a cluster, an hour of day a queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators import aggregates, filters, joins, sets
from lanehouse.plans import capacity
from lanehouse.sources import readers
from lanehouse.sources.readers import scan
from lanehouse.workload.registry import query

QUEUES_SQL = """queued AS (
  SELECT event_id, ts, user_id, event_type, props, value, 'c' || user_id AS cluster,
         'hpc_' || lpad(CAST(hour(ts) AS VARCHAR), 2, '0') AS queue FROM events)"""
PLAN_SQL = f"""{QUEUES_SQL},
waits AS (
  SELECT cluster, queue, CAST(sum(CAST(floor(value / 4) AS BIGINT) + 1) AS BIGINT) AS waiting
  FROM queued WHERE event_type IN ('view', 'click', 'signup') GROUP BY ALL),
busy AS (
  SELECT cluster, queue, count(*) AS active,
         count(*) FILTER (event_type = 'error') AS queued
  FROM queued WHERE event_type IN ('purchase', 'error') GROUP BY ALL),
base AS (SELECT cluster, CAST(sum(active) AS BIGINT) AS total FROM busy GROUP BY cluster),
asked AS (
  SELECT w.cluster, w.queue, least(w.waiting, 10) AS waiting, coalesce(b.active, 0) AS active,
         coalesce(base.total, 0) AS total
  FROM waits w LEFT JOIN busy b USING (cluster, queue) LEFT JOIN base ON base.cluster = w.cluster
  WHERE coalesce(b.queued, 0) < 1),
numbered AS (
  SELECT *, CASE WHEN active > 0 AND waiting > active THEN waiting - active ELSE waiting END AS w,
         row_number() OVER (PARTITION BY cluster ORDER BY queue) AS nth FROM asked),
steps AS (
  SELECT cluster, queue, nth, CAST(w AS BIGINT) AS new_tasks, total + w < 70 AS admitted,
         CASE WHEN active > 0 AND total + w < 70 THEN total + w ELSE total END AS total
  FROM numbered WHERE nth = 1
  UNION ALL
  SELECT n.cluster, n.queue, n.nth, CAST(n.w AS BIGINT), s.total + n.w < 70,
         CASE WHEN n.active > 0 AND s.total + n.w < 70 THEN s.total + n.w ELSE s.total END
  FROM steps s JOIN numbered n ON n.cluster = s.cluster AND n.nth = s.nth + 1),
plan AS (SELECT cluster, queue, new_tasks FROM steps WHERE admitted)"""
CONF_SQL = """conf AS (
  SELECT 'hpc_' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS queue,
         'select=1:ncpus=' || (n_regionkey + 1) AS pbs_resource, lower(n_name) AS worker_queue
  FROM nation WHERE n_regionkey <> 4)"""


def queue_name() -> Column:
    return F.concat(F.lit("hpc_"), F.lpad(F.hour("ts").cast("string"), 2, "0"))


def queued(spark: SparkSession, folder: str) -> DataFrame:
    cluster = F.concat(F.lit("c"), F.col("user_id").cast("string"))
    return (
        scan(spark, folder, "events")
        .withColumn("cluster", cluster)
        .withColumn("queue", queue_name())
    )


def waiting_queues(spark: SparkSession, folder: str) -> DataFrame:
    return (
        filters.keep_in(queued(spark, folder), "event_type", ["view", "click", "signup"])
        .groupBy("cluster", "queue")
        .agg(F.sum(F.floor(F.col("value") / 4) + 1).alias("waiting"))
    )


def active_jobs(spark: SparkSession, folder: str) -> DataFrame:
    state = F.when(F.col("event_type") == "purchase", "R").when(
        F.col("event_type") == "error", "Q"
    )
    return (
        queued(spark, folder)
        .withColumn("state", F.coalesce(state, F.lit("F")))
        .groupBy("cluster", "queue", "state")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def queue_conf(spark: SparkSession, folder: str) -> DataFrame:
    return (
        scan(spark, folder, "nation")
        .where("n_regionkey <> 4")
        .select(
            F.concat(F.lit("hpc_"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias(
                "queue"
            ),
            F.concat(
                F.lit("select=1:ncpus="), (F.col("n_regionkey") + 1).cast("string")
            ).alias("pbs_resource"),
            F.lower("n_name").alias("worker_queue"),
        )
    )


@query(
    """
    SELECT CASE WHEN event_type = 'view' THEN '_kombu' WHEN event_type = 'click' THEN 'unacked_' || user_id
           WHEN event_type = 'error' THEN 'generic' ELSE 'hpc_' || user_id END AS queue,
           count(*) AS waiting
    FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1
    """
)
def queue_depth(spark: SparkSession, folder: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    queue = (
        F.when(F.col("event_type") == "view", "_kombu")
        .when(F.col("event_type") == "click", F.concat(F.lit("unacked_"), user))
        .when(F.col("event_type") == "error", "generic")
        .otherwise(F.concat(F.lit("hpc_"), user))
    )
    return aggregates.queue_depth(scan(spark, folder, "events").select(queue.alias("queue")))


@query(
    f"""
    WITH {PLAN_SQL}
    SELECT queue, CAST(sum(active) AS BIGINT) AS active, CAST(sum(queued) AS BIGINT) AS queued
    FROM busy GROUP BY queue
    UNION ALL SELECT 'all', CAST(sum(active) AS BIGINT), 0 FROM busy
    """
)
def active_totals(spark: SparkSession, folder: str) -> DataFrame:
    counts = active_jobs(spark, folder)
    total = aggregates.active_total(counts).select(
        F.lit("all").alias("queue"), "active", F.lit(0).cast("long").alias("queued")
    )
    return sets.union_all(aggregates.active_by_queue(counts), total)


@query(
    f"""
    WITH {PLAN_SQL}
    SELECT w.cluster, w.queue, w.waiting, coalesce(b.active, 0) AS active,
           coalesce(b.queued, 0) AS queued
    FROM waits w LEFT JOIN busy b USING (cluster, queue)
    """
)
def waiting_with_active(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["cluster", "queue"]
    busy = aggregates.active_by_queue(active_jobs(spark, folder), keys)
    return joins.with_active(waiting_queues(spark, folder), busy, keys)


@query(
    f"""
    WITH {QUEUES_SQL}
    SELECT cluster, queue, CASE event_type WHEN 'purchase' THEN 'R' WHEN 'error' THEN 'Q' ELSE 'F' END
             AS state, count(*) AS n
    FROM queued GROUP BY ALL
    """
)
def active_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Counts handed over as base64 of JSON, one document per cluster and queue, and read back."""
    counts = F.create_map("queue", F.create_map("state", "n"))
    documents = active_jobs(spark, folder).select(
        "cluster", F.base64(F.to_json(counts).cast("binary")).alias("value")
    )
    return readers.active_counts(documents)


@query(f"WITH {PLAN_SQL} SELECT cluster, queue, waiting FROM waits")
def waiting_documents(spark: SparkSession, folder: str) -> DataFrame:
    entries = F.array(F.create_map("queue", "waiting"))
    documents = waiting_queues(spark, folder).select("cluster", F.to_json(entries).alias("value"))
    return readers.waiting_list(documents)


@query(f"WITH RECURSIVE {PLAN_SQL} SELECT * FROM plan")
def capacity_plan(spark: SparkSession, folder: str) -> DataFrame:
    return capacity.capacity_plan(waiting_queues(spark, folder), active_jobs(spark, folder))


@query(
    f"""
    WITH RECURSIVE {PLAN_SQL}, {CONF_SQL}
    SELECT cluster, queue, new_tasks, pbs_resource, worker_queue, unnest(range(1, new_tasks + 1)) AS task
    FROM plan JOIN conf USING (queue)
    """
)
def task_expansion(spark: SparkSession, folder: str) -> DataFrame:
    return capacity.task_expansion(capacity_plan(spark, folder), queue_conf(spark, folder))


@query(
    f"""
    WITH RECURSIVE {PLAN_SQL}, {CONF_SQL}
    SELECT cluster, queue, new_tasks, pbs_resource, worker_queue, CAST(1 AS BIGINT) AS task
    FROM plan JOIN conf USING (queue)
    """
)
def task_expansion_array(spark: SparkSession, folder: str) -> DataFrame:
    return capacity.task_expansion(
        capacity_plan(spark, folder), queue_conf(spark, folder), capacity.ARRAY_MODE
    )


WORKERS_SQL = f"""{QUEUES_SQL},
workers AS (
  SELECT 'w' || event_id AS worker_id, event_type, queue,
         CASE WHEN event_type = 'signup' THEN 'generic' ELSE 'plain' END AS second,
         user_id % 3 AS active_jobs
  FROM queued),
needed AS (
  SELECT queue FROM queued GROUP BY queue
  HAVING count(*) FILTER (event_type = 'click') > count(*) FILTER (event_type = 'view')),
idle AS (
  SELECT worker_id FROM workers
  WHERE active_jobs = 0 AND second <> 'generic' AND queue NOT IN (SELECT queue FROM needed))"""


def worker_replies(spark: SparkSession, folder: str, queue: Column | str = "queue") -> DataFrame:
    """Worker replies as JSON text; a worker without jobs may lack the list of jobs."""
    job = F.struct(F.col("event_type").alias("id"), F.lit("run").alias("name"))
    jobs = F.transform(fn.one_to(F.col("user_id") % 3), lambda n: job)
    active = F.when(F.col("user_id") % 6 != 0, jobs)
    second = F.when(F.col("event_type") == "signup", "generic").otherwise("plain")
    first = F.col(queue) if isinstance(queue, str) else queue
    queues = F.array(F.struct(first.alias("name")), F.struct(second.alias("name")))
    worker = F.struct(active.alias("active"), queues.alias("active_queues"))
    name = F.concat(F.lit("w"), F.col("event_id").cast("string"))
    return queued(spark, folder).select(F.to_json(F.create_map(name, worker)).alias("value"))


def needed_queues(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return (
        queued(spark, folder)
        .groupBy("queue")
        .agg(F.count_if(kind == "click").alias("clicks"), F.count_if(kind == "view").alias("views"))
        .where("clicks > views")
        .select("queue")
    )


@query(
    f"""
    WITH {WORKERS_SQL}
    SELECT worker_id, active_jobs, queue || ',' || second AS queues FROM workers
    """
)
def worker_arrays(spark: SparkSession, folder: str) -> DataFrame:
    workers = readers.worker_list(worker_replies(spark, folder))
    return workers.withColumn("queues", F.concat_ws(",", "queues"))


@query(f"WITH {WORKERS_SQL} SELECT * FROM idle")
def idle_workers(spark: SparkSession, folder: str) -> DataFrame:
    workers = readers.worker_list(worker_replies(spark, folder))
    return capacity.idle_workers(workers, needed_queues(spark, folder))


# Workers of low value still serve a queue of their cluster's, which no task waits for any more
CLEANUP_SQL = f"""{PLAN_SQL}, {CONF_SQL},
serving AS (
  SELECT 'w' || event_id AS worker_id, user_id % 3 AS active_jobs, event_type,
         CASE WHEN value < 10 THEN 'hpc_' || cluster ELSE queue END AS queue FROM queued),
idle AS (
  SELECT worker_id FROM serving
  WHERE active_jobs = 0 AND event_type <> 'signup' AND queue NOT IN (SELECT queue FROM plan))"""


def cleanup(spark: SparkSession, folder: str) -> capacity.Cleanup:
    own = F.concat(F.lit("hpc_"), "cluster")
    replies = worker_replies(spark, folder, F.when(F.col("value") < 10, own).otherwise(F.col("queue")))
    return capacity.worker_cleanup(
        readers.worker_list(replies),
        waiting_queues(spark, folder),
        active_jobs(spark, folder),
        queue_conf(spark, folder),
    )


@query(
    f"""
    WITH RECURSIVE {CLEANUP_SQL}
    SELECT DISTINCT queue AS branch FROM plan
    UNION ALL SELECT 'cleanup_celery_workers' WHERE EXISTS (SELECT 1 FROM idle)
    """
)
def worker_branches(spark: SparkSession, folder: str) -> DataFrame:
    return cleanup(spark, folder).branches


@query(f"WITH RECURSIVE {CLEANUP_SQL} SELECT * FROM idle")
def cleanup_idle(spark: SparkSession, folder: str) -> DataFrame:
    return cleanup(spark, folder).idle


@query(
    f"""
    WITH RECURSIVE {CLEANUP_SQL}
    SELECT cluster, queue, new_tasks, pbs_resource, worker_queue FROM plan JOIN conf USING (queue)
    """
)
def cleanup_plan(spark: SparkSession, folder: str) -> DataFrame:
    return cleanup(spark, folder).plan


@query(
    """
    SELECT 'hpc_' || user_id AS queue, arg_max(CAST(floor(value) AS BIGINT), event_id) AS waiting
    FROM events GROUP BY 1
    """
)
def unique_queues(spark: SparkSession, folder: str) -> DataFrame:
    entries = scan(spark, folder, "events").select(
        F.concat(F.lit("hpc_"), F.col("user_id").cast("string")).alias("queue"),
        F.floor("value").alias("waiting"),
        "event_id",
    )
    return aggregates.unique_queues(entries, "waiting", "event_id")


@query(
    f"""
    WITH {QUEUES_SQL},
    j AS (SELECT queue, count(*) AS n FROM queued WHERE event_type = 'purchase' AND value > 50
          GROUP BY 1),
    w AS (SELECT queue, count(*) AS n FROM queued WHERE event_type = 'view' AND hour(ts) < 12 GROUP BY 1),
    m AS (SELECT queue, count(*) AS n FROM queued WHERE event_type = 'error' AND hour(ts) > 6 GROUP BY 1)
    SELECT queue, coalesce(j.n, 0) AS jobs, coalesce(w.n, 0) AS workers, coalesce(m.n, 0) AS waiting
    FROM j FULL JOIN w USING (queue) FULL JOIN m USING (queue)
    """
)
def fanin_three(spark: SparkSession, folder: str) -> DataFrame:
    events = queued(spark, folder)

    def counted(condition: str) -> DataFrame:
        return events.where(condition).groupBy("queue").agg(F.count(F.lit(1)).alias("n"))

    return joins.by_queue(
        jobs=counted("event_type = 'purchase' AND value > 50"),
        workers=counted("event_type = 'view' AND hour(ts) < 12"),
        waiting=counted("event_type = 'error' AND hour(ts) > 6"),
    )
