"""Sample sheets: a customer is a sample, the region a run, the market segment a project."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.operators import aggregates, filters, joins, numbering, sets, windows
from lanehouse.plans import sheets
from lanehouse.sources.readers import scan
from lanehouse.workload.registry import query

SAMPLES_SQL = """samples AS (
  SELECT n_regionkey AS run, c_mktsegment AS project, n_nationkey % 4 + 1 AS lane, c_custkey,
         CASE WHEN c_custkey % 3 = 0 THEN 16 ELSE 8 END AS len,
         CASE WHEN c_custkey % 3 = 0 THEN 'Y150N1;I8N2;N2I8;Y150N1'
              ELSE 'Y150N1;I8N2;N10;Y150N1' END AS bases_mask,
         CASE WHEN c_custkey % 3 = 1 THEN '10X' ELSE 'NA' END AS tag
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
SHEETS_SQL = f"""{SAMPLES_SQL},
grouped AS (
  SELECT run, project, lane, bases_mask, len || '_' || tag AS index_group, count(*) AS sample_counts
  FROM samples GROUP BY ALL),
sheets AS (
  SELECT run, project, dense_rank() OVER (PARTITION BY run ORDER BY project) AS project_index,
         lane, dense_rank() OVER (PARTITION BY run, project ORDER BY lane) AS lane_index,
         bases_mask, index_group,
         dense_rank() OVER (PARTITION BY run, project, lane ORDER BY index_group)
           AS index_group_index,
         sample_counts,
         'SampleSheet_' || project || '_' || lane || '_' || index_group || '.csv' AS samplesheet_file
  FROM grouped)"""


def samples(spark: SparkSession, folder: str) -> DataFrame:
    customer = scan(spark, folder, "customer")
    nation = scan(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    kind = F.col("c_custkey") % 3
    mask = F.when(kind == 0, "Y150N1;I8N2;N2I8;Y150N1").otherwise("Y150N1;I8N2;N10;Y150N1")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_regionkey").alias("run"),
        F.col("c_mktsegment").alias("project"),
        (F.col("n_nationkey") % 4 + 1).alias("lane"),
        "c_custkey",
        mask.alias("bases_mask"),
        F.when(kind == 1, "10X").otherwise("NA").alias("tag"),
    )


@query(f"WITH {SHEETS_SQL} SELECT * FROM sheets")
def sheet_index(spark: SparkSession, folder: str) -> DataFrame:
    return sheets.formatted_sheets(samples(spark, folder))


@query(
    f"""
    WITH {SHEETS_SQL}
    SELECT run, project_index, lane_index, index_group_index, CAST(sum(sample_counts) AS BIGINT) AS n
    FROM sheets GROUP BY ALL
    """
)
def sheet_groups_map(spark: SparkSession, folder: str) -> DataFrame:
    return sheets.sample_groups(sheet_index(spark, folder))


@query(
    f"""
    WITH {SHEETS_SQL}
    SELECT run, project_index, lane_index, index_group_index,
           unnest(range(1, sample_counts + 1)) AS sample
    FROM sheets
    """
)
def sheet_tasks(spark: SparkSession, folder: str) -> DataFrame:
    return sheets.sheet_tasks(sheet_index(spark, folder))


@query(
    """
    SELECT event_id, user_id % 3 AS project_index, event_type AS lane, unnest([1, 2]) AS index_group,
           unnest([user_id, event_id % 7]) AS n
    FROM events WHERE user_id % 3 = 2
    """
)
def nested_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Counts that arrive as a map of maps in one row."""
    groups = F.create_map(F.lit(1), "user_id", F.lit(2), F.col("event_id") % 7)
    events = scan(spark, folder, "events").select(
        "event_id", F.create_map(F.col("user_id") % 3, F.create_map("event_type", groups)).alias("counts")
    )
    rows = sets.expand_nested(events, "counts", ["project_index", "lane", "index_group"], "n")
    return filters.route(rows, project_index=2)


@query(
    f"""
    WITH {SAMPLES_SQL}
    SELECT coalesce(CAST(run AS VARCHAR), 'all') AS run, coalesce(project, 'all') AS project,
           coalesce(CAST(lane AS VARCHAR), 'all') AS lane, coalesce(tag, 'all') AS tag,
           count(*) AS n, grouping(run, project, lane, tag) AS "grouping"
    FROM samples GROUP BY ROLLUP (run, project, lane, tag)
    """
)
def fan_in_rollup(spark: SparkSession, folder: str) -> DataFrame:
    levels = ["run", "project", "lane", "tag"]
    totals = aggregates.fan_in(samples(spark, folder), levels)
    return totals.withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit("all")) for c in levels}
    )


@query(
    """
    SELECT l_returnflag AS project, l_linenumber AS lane, l_suppkey AS sample,
           CAST(sum(l_quantity) AS BIGINT) AS reads
    FROM lineitem GROUP BY ALL
    """
)
def sample_read_counts(spark: SparkSession, folder: str) -> DataFrame:
    reads = scan(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("project"),
        F.col("l_linenumber").alias("lane"),
        F.col("l_suppkey").alias("sample"),
        F.col("l_quantity").cast("long").alias("n"),
    )
    return aggregates.sample_counts(reads, ["project", "lane", "sample"], "n")


@query(
    """
    SELECT l_orderkey, l_returnflag || ':' || l_suppkey || ':' || l_linenumber AS path,
           row_number() OVER (PARTITION BY l_orderkey
             ORDER BY CASE l_returnflag WHEN 'R' THEN 1 ELSE 2 END,
                      l_returnflag || ':' || l_suppkey || ':' || l_linenumber) AS position
    FROM lineitem WHERE l_returnflag IN ('R', 'N')
    """
)
def tool_order(spark: SparkSession, folder: str) -> DataFrame:
    reports = scan(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_returnflag",
        F.concat_ws(":", "l_returnflag", "l_suppkey", "l_linenumber").alias("path"),
    )
    return aggregates.ordered_reports(
        reports, ["l_orderkey"], "l_returnflag", "path", order=["R", "N"]
    )


@query(
    f"""
    WITH {SHEETS_SQL},
    groups AS (SELECT DISTINCT project, lane FROM sheets),
    reports AS (SELECT c_mktsegment AS project, c_nationkey % 6 AS lane, c_name AS report
                FROM customer WHERE c_acctbal > 0)
    SELECT project, lane, coalesce(report, 'none') AS report
    FROM groups LEFT JOIN reports USING (project, lane)
    """
)
def attached_reports(spark: SparkSession, folder: str) -> DataFrame:
    groups = sheet_index(spark, folder).select("project", "lane").distinct()
    reports = (
        scan(spark, folder, "customer")
        .where("c_acctbal > 0")
        .select(
            F.col("c_mktsegment").alias("project"),
            (F.col("c_nationkey") % 6).alias("lane"),
            F.col("c_name").alias("report"),
        )
    )
    attached = joins.attach_reports(groups, reports, ["project", "lane"])
    return attached.withColumn("report", F.coalesce("report", F.lit("none")))


@query(
    """
    SELECT p_size AS analysis, count(*) > 1 AS needs_aggregate
    FROM part WHERE p_type <> 'ECONOMY' AND p_brand <> 'Brand#1' GROUP BY p_size
    """
)
def tag_groups(spark: SparkSession, folder: str) -> DataFrame:
    def tag(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    kind = F.when(F.col("p_type") == "ECONOMY", "Multiplexing").otherwise("Gene Expression")
    library = F.when(F.col("p_brand") == "Brand#1", "Antibody").otherwise("Gene Expression")
    design = scan(spark, folder, "part").select(
        F.col("p_size").alias("analysis"),
        F.array(tag("feature_types", kind), tag("library_types", library)).alias("tags"),
    )
    groups = filters.groups_with_tag(design, "tags", "feature_types", "Gene Expression")
    groups = filters.groups_with_tag(groups, "tags", "library_types", "Gene Expression")
    return aggregates.needs_aggregate(groups, "analysis")


@query("SELECT o_orderkey, o_custkey, ntile(50) OVER (ORDER BY o_orderkey) AS chunk FROM orders")
def chunks_exact(spark: SparkSession, folder: str) -> DataFrame:
    orders = scan(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return numbering.chunk(orders, ["o_orderkey"], 50)


@query(
    """
    SELECT o_orderpriority, o_orderkey,
           row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS slot
    FROM orders QUALIFY slot <= 40
    """
)
def top_slots(spark: SparkSession, folder: str) -> DataFrame:
    orders = scan(spark, folder, "orders").select("o_orderpriority", "o_orderkey")
    return windows.slots(orders, ["o_orderpriority"], ["o_orderkey"], 40)


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def first_designs(spark: SparkSession, folder: str) -> DataFrame:
    return windows.first_n(
        scan(spark, folder, "orders"), [F.desc("o_totalprice"), "o_orderkey"], 20
    )


@query(
    """
    SELECT page_id, url, coalesce(nullif(regexp_extract(url, '/(en|fr|de)/', 1), ''), 'additional') AS lane
    FROM pages
    """
)
def lane_split(spark: SparkSession, folder: str) -> DataFrame:
    files = scan(spark, folder, "pages").select("page_id", "url")
    return windows.lane_or_rest(files, "url", "/(en|fr|de)/")


@query(
    """
    SELECT '/run/' || l_orderkey || '/L00' || l_linenumber + l_suppkey % 4 || '/r1.fq' AS path,
           CASE WHEN l_linenumber + l_suppkey % 4 <= 8
                THEN CAST(l_linenumber + l_suppkey % 4 AS VARCHAR) ELSE 'additional' END AS lane
    FROM lineitem
    """
)
def lane_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of lanes 1 to 8 by the usual pattern; lanes above are none."""
    lane = (F.col("l_linenumber") + F.col("l_suppkey") % 4).cast("string")
    order = F.col("l_orderkey").cast("string")
    path = F.concat(F.lit("/run/"), order, F.lit("/L00"), lane, F.lit("/r1.fq"))
    files = scan(spark, folder, "lineitem").select(path.alias("path"))
    return windows.lane_or_rest(files, "path")
