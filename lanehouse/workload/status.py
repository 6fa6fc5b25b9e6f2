"""Status changes, registration, intake, validation and graph checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.operators import aggregates, filters, joins, windows
from lanehouse.plans import graph, status
from lanehouse.sources.readers import scan
from lanehouse.workload.registry import query


@query(
    """
    SELECT o.o_orderkey,
           CASE WHEN l.o_orderkey IS NOT NULL AND coalesce(o.o_orderstatus NOT IN ('F', 'P'), true)
                THEN 'RUNNING' ELSE o.o_orderstatus END AS o_orderstatus,
           l.o_orderkey IS NOT NULL AND coalesce(o.o_orderstatus NOT IN ('F', 'P'), true) AS changed
    FROM orders o
    LEFT JOIN (SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem WHERE l_returnflag = 'R') l
      USING (o_orderkey)
    """
)
def status_transition(spark: SparkSession, folder: str) -> DataFrame:
    table = scan(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    ids = (
        scan(spark, folder, "lineitem")
        .where("l_returnflag = 'R'")
        .select(F.col("l_orderkey").alias("o_orderkey"))
    )
    return status.status_transition(
        table, ids, "o_orderkey", "o_orderstatus", "RUNNING", ["F", "P"]
    )


@query(
    """
    WITH seeds AS (
      SELECT event_id, user_id,
             CASE event_type WHEN 'view' THEN 'SEEDED' WHEN 'click' THEN 'RUNNING'
                  WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'FINISHED' END AS status
      FROM events)
    SELECT event_id, user_id,
           CASE WHEN c_acctbal > 0 AND coalesce(status NOT IN ('SEEDED', 'FAILED'), true)
                THEN 'FINISHED' ELSE status END AS status,
           coalesce(c_acctbal > 0, false) AND coalesce(status NOT IN ('SEEDED', 'FAILED'), true)
             AS changed
    FROM seeds LEFT JOIN customer ON c_custkey = user_id
    """
)
def analysis_finished(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    current = (
        F.when(kind == "view", "SEEDED")
        .when(kind == "click", "RUNNING")
        .when(kind == "error", "FAILED")
        .when(kind == "purchase", "FINISHED")
    )
    table = scan(spark, folder, "events").select("event_id", "user_id", current.alias("status"))
    ids = (
        scan(spark, folder, "customer")
        .where("c_acctbal > 0")
        .select(F.col("c_custkey").alias("user_id"))
    )
    return status.apply_transition(table, ids, "user_id", "status", status.ANALYSIS_FINISHED)


@query("SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def known_anti(spark: SparkSession, folder: str) -> DataFrame:
    known = (
        scan(spark, folder, "orders")
        .where("o_totalprice > 400000")
        .select(F.col("o_custkey").alias("c_custkey"))
    )
    return joins.unknown(scan(spark, folder, "customer"), known, "c_custkey")


@query(
    """
    SELECT c_custkey, c_name, nullif(c_nationkey, 3) AS nation FROM customer
    WHERE nullif(c_nationkey, 3) NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < -800)
    """
)
def not_in_rule(spark: SparkSession, folder: str) -> DataFrame:
    values = scan(spark, folder, "supplier").where("s_acctbal < -800")
    customer = scan(spark, folder, "customer").select(
        "c_custkey", "c_name", F.nullif(F.col("c_nationkey"), F.lit(3)).alias("nation")
    )
    return joins.anti_not_in(customer, "nation", values, "s_nationkey")


@query(
    """
    SELECT c_custkey, c_name, true AS synced,
           CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
                THEN 'duplicate' ELSE 'registered' END AS outcome
    FROM customer
    """
)
def register_new(spark: SparkSession, folder: str) -> DataFrame:
    raw = scan(spark, folder, "customer").select("c_custkey", "c_name")
    registered = (
        scan(spark, folder, "orders")
        .where("o_orderstatus = 'P'")
        .select(F.col("o_custkey").alias("c_custkey"))
    )
    return status.register_new(raw, registered, "c_custkey")


INTAKE_SQL = """listing AS (SELECT l_orderkey AS run, l_linenumber = 1 AS marker FROM lineitem),
complete AS (
  SELECT run, bool_or(marker) AS complete FROM listing
  WHERE run NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY run)"""


def run_listing(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """File listings of runs: line 1 of an order is the marker file; finished orders are known."""
    name = F.when(F.col("l_linenumber") == 1, "RunInfo.xml").otherwise(
        F.concat(F.lit("Data/L"), F.col("l_linenumber").cast("string"), F.lit(".cbcl"))
    )
    path = F.concat_ws("/", F.lit("/runs"), F.col("l_orderkey").cast("string"), name)
    listing = scan(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("run"), path.alias("path")
    )
    known = (
        scan(spark, folder, "orders")
        .where("o_orderstatus = 'F'")
        .select(F.col("o_orderkey").alias("run"))
    )
    return listing, known


@query(f"WITH {INTAKE_SQL} SELECT * FROM complete")
def new_runs(spark: SparkSession, folder: str) -> DataFrame:
    listing, known = run_listing(spark, folder)
    return status.new_runs(listing, known, "run", "path")


@query(f"WITH {INTAKE_SQL} SELECT run FROM complete WHERE complete")
def run_intake(spark: SparkSession, folder: str) -> DataFrame:
    listing, known = run_listing(spark, folder)
    return status.run_intake(listing, known, "run", "path")


@query(f"WITH {INTAKE_SQL} SELECT min(run) AS run FROM complete WHERE complete")
def next_run(spark: SparkSession, folder: str) -> DataFrame:
    return windows.pick_one(run_intake(spark, folder), ["run"])


@query(
    """
    SELECT doc_id, source, coalesce(quality, -1) AS quality, quality IS NOT NULL AS matched
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def slide_match(spark: SparkSession, folder: str) -> DataFrame:
    slides = scan(spark, folder, "documents").select("doc_id", "source")
    projects = scan(spark, folder, "labels").select("doc_id", "quality")
    return joins.match_ids(slides, projects, "doc_id").withColumn(
        "quality", F.coalesce("quality", F.lit(-1))
    )


@query(
    """
    SELECT doc_id, 'text required' AS rule FROM documents WHERE trim(text) = ''
    UNION ALL SELECT doc_id, 'lang not allowed' FROM documents WHERE lang NOT IN ('en', 'fr')
    UNION ALL SELECT doc_id, 'source not numbered' FROM documents
              WHERE try_cast(replace(source, 'src1', '') AS INTEGER) IS NULL
    UNION ALL SELECT doc_id, 'too long' FROM documents WHERE n_chars > 5000
    """
)
def rule_violations(spark: SparkSession, folder: str) -> DataFrame:
    documents = scan(spark, folder, "documents").select(
        "doc_id",
        "lang",
        "n_chars",
        F.nullif(F.trim("text"), F.lit("")).alias("text"),
        F.replace("source", F.lit("src1"), F.lit("")).alias("number"),
    )
    rules = {
        "text required": filters.required("text"),
        "lang not allowed": filters.not_allowed("lang", ["en", "fr"]),
        "source not numbered": filters.not_typed("number", "int"),
        "too long": F.col("n_chars") > 5000,
    }
    return filters.violations(documents, ["doc_id"], rules)


@query(
    """
    SELECT l_orderkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_linenumber END) AS BIGINT) AS n
    FROM lineitem GROUP BY 1 HAVING coalesce(n, 0) = 0
    """
)
def empty_counts(spark: SparkSession, folder: str) -> DataFrame:
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_linenumber"))
    stats = scan(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.sum(returned).alias("n"))
    return filters.empty_counts(stats, "n")


EDGES_SQL = """edges AS (
  SELECT DISTINCT 'c' || o_custkey AS src, o_orderpriority AS dst FROM orders),
expected AS (
  SELECT DISTINCT 'c' || o_custkey AS task, o_orderpriority AS neighbour
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00'
  UNION SELECT 'x' || c_custkey, NULL FROM customer WHERE c_acctbal < 0
  UNION SELECT 'c' || c_custkey, NULL FROM customer WHERE c_custkey NOT IN (
    SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01 00:00:00'))"""


def order_edges(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "orders").select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("src"),
        F.col("o_orderpriority").alias("dst"),
    )


@query(
    f"""
    WITH {EDGES_SQL},
    tasks AS (SELECT 'c' || c_custkey AS task FROM customer),
    want AS (SELECT * FROM expected WHERE neighbour IS NOT NULL),
    missing AS (SELECT task, count(*) AS n FROM (
      SELECT task, neighbour FROM want EXCEPT SELECT src, dst FROM edges) GROUP BY task),
    unexpected AS (SELECT src AS task, count(*) AS n FROM (
      SELECT src, dst FROM edges EXCEPT SELECT task, neighbour FROM want) GROUP BY src)
    SELECT e.task, t.task IS NOT NULL AS known, coalesce(m.n, 0) AS missing,
           coalesce(u.n, 0) AS unexpected,
           t.task IS NOT NULL AND coalesce(m.n, 0) = 0 AND coalesce(u.n, 0) = 0 AS same
    FROM (SELECT DISTINCT task FROM expected) e LEFT JOIN tasks t ON t.task = e.task
    LEFT JOIN missing m ON m.task = e.task LEFT JOIN unexpected u ON u.task = e.task
    """
)
def graph_check(spark: SparkSession, folder: str) -> DataFrame:
    orders = scan(spark, folder, "orders")
    customer = scan(spark, folder, "customer")
    early = orders.where(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz"))
    name = F.concat(F.lit("c"), F.col("c_custkey").cast("string"))
    none = F.lit(None).cast("string").alias("neighbour")
    with_edges = order_edges(spark, folder)
    expected = (
        early.select(
            F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("task"),
            F.col("o_orderpriority").alias("neighbour"),
        )
        .unionByName(
            customer.where("c_acctbal < 0").select(
                F.concat(F.lit("x"), F.col("c_custkey").cast("string")).alias("task"), none
            )
        )
        .unionByName(
            customer.join(early, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select(
                name.alias("task"), none
            )
        )
    )
    return graph.graph_check(with_edges, expected, customer.select(name.alias("task")))


@query(
    f"""
    WITH {EDGES_SQL}
    SELECT DISTINCT dst AS task, src AS neighbour FROM edges
    UNION ALL
    SELECT DISTINCT src, dst FROM edges
    """
)
def adjacency_sets(spark: SparkSession, folder: str) -> DataFrame:
    edges = order_edges(spark, folder)
    return aggregates.adjacency(edges, "upstream").unionByName(
        aggregates.adjacency(edges, "downstream")
    )
