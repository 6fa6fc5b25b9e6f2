"""Lines, tokens, JSON and scalar expressions over ``documents``, ``pages`` and ``events``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.functions import masks
from lanehouse.operators import filters, windows
from lanehouse.operators.aggregates import job_counts as count_jobs
from lanehouse.plans import capacity
from lanehouse.sources import readers
from lanehouse.sources.readers import scan
from lanehouse.workload.registry import query

LINES_SQL = """cells AS (
  SELECT doc_id, string_split(regexp_replace(text, '\\n\\z', ''), chr(10)) AS cell FROM documents),
lines AS (
  SELECT doc_id, CAST(generate_subscripts(cell, 1) - 1 AS INTEGER) AS pos, unnest(cell) AS line
  FROM cells)"""


def document_lines(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "documents").select(
        "doc_id", F.posexplode(fn.text_lines("text")).alias("pos", "line")
    )


# --- job reports made of events: three to four lines per event, one report per day ------------


def job_name() -> Column:
    prefix = F.when(F.col("event_type") == "signup", F.lit("local_")).otherwise(F.lit("hpc_"))
    return F.concat(prefix, (F.col("user_id") % 12).cast("string"))


def job_state() -> Column:
    return (
        F.when(F.col("event_type").isin("purchase", "signup"), "R")
        .when(F.col("event_type") == "error", "Q")
        .when(F.col("event_type") == "view", "F")
        .otherwise("H")
    )


JOBS_SQL = """jobs AS (
  SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS file,
         CASE WHEN event_type = 'signup' THEN 'local_' ELSE 'hpc_' END || (user_id % 12) AS name,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'R' WHEN event_type = 'error' THEN 'Q'
              WHEN event_type = 'view' THEN 'F' ELSE 'H' END AS state,
         event_type = 'click' AS nameless
  FROM events)"""
RECORDS_SQL = f"""{JOBS_SQL},
named AS (
  SELECT event_id, file, event_id * 4 + 3 AS pos, event_id || '.pbs' AS job_id,
         coalesce(last_value(CASE WHEN NOT nameless THEN name END IGNORE NULLS)
           OVER (PARTITION BY file ORDER BY event_id), '') AS job_name, state AS job_state
  FROM jobs),
records AS (
  SELECT file, pos, job_id, job_name, job_state FROM named
  WHERE contains(job_id || ',' || job_name || ',' || job_state, 'hpc'))"""


def job_report(spark: SparkSession, folder: str) -> DataFrame:
    """Report lines; a click has no name line, so it takes the name of the job above it."""
    lines = F.array(
        F.concat(F.lit("Job Id: "), F.col("event_id").cast("string"), F.lit(".pbs")),
        F.when(F.col("event_type") != "click", F.concat(F.lit("    Job_Name = "), job_name())),
        F.lit("\tResource_List.ncpus = 4"),
        F.concat(F.lit("    job_state = "), job_state()),
    )
    return (
        scan(spark, folder, "events")
        .select(
            F.col("ts").cast("date").cast("string").alias("file"),
            "event_id",
            F.posexplode(lines).alias("nth", "line"),
        )
        .where(F.col("line").isNotNull())
        .select("file", (F.col("event_id") * 4 + F.col("nth")).alias("pos"), "line")
    )


@query(f"WITH {RECORDS_SQL} SELECT * FROM records")
def job_records(spark: SparkSession, folder: str) -> DataFrame:
    return capacity.job_records(job_report(spark, folder), ["file"])


@query(f"WITH {RECORDS_SQL} SELECT * FROM records")
def job_records_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The same with blocks so short that ids and names are handed on from one to the next."""
    return capacity.job_records(job_report(spark, folder), ["file"], span=64)


@query(
    f"""
    WITH {RECORDS_SQL}
    SELECT job_name, count(*) FILTER (job_state = 'Q') AS "Q",
           count(*) FILTER (job_state = 'R') AS "R"
    FROM records WHERE job_name LIKE 'hpc%' AND job_state IN ('Q', 'R') GROUP BY job_name
    """
)
def job_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_jobs(job_records(spark, folder), "hpc")


@query(
    f"""
    WITH {JOBS_SQL}
    SELECT name AS job_name, count(*) FILTER (state = 'Q') AS "Q",
           count(*) FILTER (state = 'R') AS "R"
    FROM jobs WHERE state IN ('Q', 'R') AND name LIKE 'local%' GROUP BY name
    """
)
def job_dump_counts(spark: SparkSession, folder: str) -> DataFrame:
    job = F.struct(job_name().alias("Job_Name"), job_state().alias("job_state"))
    dump = F.struct(F.create_map(F.col("event_id").cast("string"), job).alias("Jobs"))
    documents = scan(spark, folder, "events").select(F.to_json(dump).alias("value"))
    return count_jobs(readers.job_dump(documents), "local")


# --- lines of documents -----------------------------------------------------------------------


HEADS_SQL = f"""
    WITH {LINES_SQL},
    marked AS (
      SELECT doc_id, pos, line,
             CASE WHEN contains(line, 'License') OR contains(line, ':') THEN line END AS head
      FROM lines)
    SELECT doc_id, pos, line, last_value(head IGNORE NULLS)
             OVER (PARTITION BY doc_id ORDER BY pos) AS head
    FROM marked
    """


@query(HEADS_SQL)
def text_sections(spark: SparkSession, folder: str) -> DataFrame:
    sections = windows.sections_of_text(
        F.col("text"), lambda line: fn.has_any(line, ["License", ":"])
    )
    return (
        scan(spark, folder, "documents")
        .select("doc_id", F.inline(sections))
        .select("doc_id", "start", "head", F.posexplode("lines").alias("nth", "line"))
        .select("doc_id", (F.col("start") + F.col("nth")).alias("pos"), "line", "head")
    )


@query(HEADS_SQL)
def carried_heads(spark: SparkSession, folder: str) -> DataFrame:
    head = F.when(fn.has_any("line", ["License", ":"]), F.col("line"))
    lines = document_lines(spark, folder).withColumn("head", head)
    return windows.carry_forward(lines, ["doc_id"], "pos", ["head"], span=None)


@query(
    f"""
    WITH {LINES_SQL},
    hits AS (SELECT *, regexp_matches(line, '(^|\\W)the(\\W|$)') AS hit FROM lines)
    SELECT doc_id, pos, line FROM (
      SELECT *, lag(hit, 1, false) OVER (PARTITION BY doc_id ORDER BY pos) AS after FROM hits)
    WHERE hit OR after
    """
)
def after_context(spark: SparkSession, folder: str) -> DataFrame:
    return windows.after_context(
        document_lines(spark, folder), fn.has_word("line", "the"), ["doc_id"]
    )


@query(
    f"""
    WITH {LINES_SQL},
    hits AS (SELECT *, regexp_matches(line, '(^|\\W)License(\\W|$)') AS hit FROM lines)
    SELECT doc_id, pos, line FROM (
      SELECT *, lag(hit, 1, false) OVER w OR lag(hit, 2, false) OVER w AS after FROM hits
      WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
    WHERE hit OR after
    """
)
def context_of_text(spark: SparkSession, folder: str) -> DataFrame:
    near = windows.context_of_text(F.col("text"), "License", 2)
    return scan(spark, folder, "documents").select("doc_id", F.inline(near))


@query(
    f"""
    WITH {LINES_SQL},
    parts AS (
      SELECT *, regexp_extract_all(line, '[^ \\t]+') AS t, string_split(line, ' ') AS c FROM lines)
    SELECT doc_id, pos,
           coalesce(t[3], '') || ' ' || coalesce(t[4], '') || ' ' || coalesce(t[6], '') AS tokens,
           CASE WHEN contains(line, ' ') THEN concat_ws(' ', c[13], c[15]) ELSE line END AS cut,
           coalesce(t[1], '') || ',' || coalesce(t[2], '') AS record
    FROM parts
    """
)
def line_fields(spark: SparkSession, folder: str) -> DataFrame:
    return document_lines(spark, folder).select(
        "doc_id",
        "pos",
        fn.tokens("line", [3, 4, 6]).alias("tokens"),
        fn.cut_spaces("line", [13, 15]).alias("cut"),
        fn.joined(",", fn.field("line", 1), fn.field("line", 2)).alias("record"),
    )


@query(
    f"""
    WITH {LINES_SQL}
    SELECT doc_id, pos, line FROM lines
    WHERE (contains(line, 'License') OR contains(line, 'reserved') OR contains(line, '@'))
      AND contains(doc_id || ',' || pos || ',' || line, '1')
    """
)
def keep_lines(spark: SparkSession, folder: str) -> DataFrame:
    kept = filters.keep_any(
        document_lines(spark, folder), "line", ["License", "reserved", "@"]
    )
    return kept.where(fn.row_contains(["doc_id", "pos", "line"], "1"))


# --- scalar expressions -----------------------------------------------------------------------


@query(
    """
    WITH d AS (SELECT event_id, user_id, event_type, json_extract_string(props, '$.k') AS k FROM events)
    SELECT event_id, CAST(k AS INTEGER) AS k,
           '{"type":"' || event_type || '","ids":{"user":' || user_id || '}}' AS document,
           user_id AS nested_user
    FROM d
    """
)
def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    props = fn.from_b64(F.base64(F.concat(F.lit(" \n"), F.col("props"), F.lit("\n")).cast("binary")))
    ids = F.struct(F.col("user_id").alias("user"))
    document = fn.as_json(F.col("event_type").alias("type"), ids.alias("ids"))
    parsed = scan(spark, folder, "events").select(
        "event_id",
        fn.parse_json(props, "k int").alias("props"),
        document.alias("document"),
        fn.parse_json(document, "type string, ids struct<user: bigint>").alias("parsed"),
    )
    return parsed.select(
        "event_id", F.col("props.k").alias("k"), "document",
        F.col("parsed.ids.user").alias("nested_user"),
    )


@query(
    """
    SELECT page_id, string_split(url, '/')[-1] AS base,
           '/data/' || string_split(url, '/')[3] || '/' || string_split(url, '/')[-1] AS joined,
           url AS absolute,
           regexp_replace(string_split(url, '/')[-1] || '.py', '\\.pyc?$', '') AS stem,
           'page ' || printf('%05d', page_id) || ' of ' || string_split(url, '/')[3] AS label,
           contains(url, 'blog') AS is_blog,
           coalesce(nullif(regexp_extract(url, '#(.*)$', 1), ''), 'none') AS anchor
    FROM pages
    """
)
def path_functions(spark: SparkSession, folder: str) -> DataFrame:
    host = F.get(F.split("url", "/"), F.lit(2))
    base = fn.base_name("url")
    anchor = F.nullif(F.regexp_extract("url", "#(.*)$", 1), F.lit(""))
    return scan(spark, folder, "pages").select(
        "page_id",
        base.alias("base"),
        fn.join_path(F.lit("/data/"), host, base).alias("joined"),
        F.substr(
            fn.join_path(F.lit("/data"), F.concat(F.lit("/"), F.col("url"))), F.lit(2)
        ).alias("absolute"),
        fn.stem(F.concat("url", F.lit(".py"))).alias("stem"),
        fn.formatted("page %05d of %s", F.col("page_id"), host).alias("label"),
        fn.has_text("url", "blog").alias("is_blog"),
        F.coalesce(anchor, F.lit("none")).alias("anchor"),
    )


@query(
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS tag,
           CASE WHEN o_custkey % 50 < 1 THEN 30 ELSE o_custkey % 50 END AS days,
           strftime(TIMESTAMP '2002-01-01 06:00:00'
             - to_days(CAST(CASE WHEN o_custkey % 50 < 1 THEN 30 ELSE o_custkey % 50 END AS INTEGER)),
             '%Y-%m-%d %H:%M:%S') AS cutoff,
           least(o_custkey, 10) AS capped, o_custkey - least(o_custkey, 10) AS rest,
           o_orderstatus = 'F' AND o_custkey % 2 = 1 AS is_false_flag
    FROM orders
    """
)
def scalar_pack(spark: SparkSession, folder: str) -> DataFrame:
    now = F.lit("2002-01-01 06:00:00").cast("timestamp_ntz")
    days = fn.age_or_default(F.nullif(F.col("o_custkey") % 50, F.lit(0)))
    capped = fn.capped("o_custkey", 10)
    flag = F.when(
        F.col("o_orderstatus") == "F", F.when(F.col("o_custkey") % 2 == 1, False).otherwise(True)
    )
    return scan(spark, folder, "orders").select(
        "o_orderkey",
        fn.date_tag("o_orderdate").alias("tag"),
        days.alias("days"),
        fn.cutoff(now, days.cast("int")).cast("string").alias("cutoff"),
        capped.alias("capped"),
        (F.col("o_custkey") - capped).alias("rest"),
        F.coalesce(fn.is_false(flag), F.lit(False)).alias("is_false_flag"),
    )


@query(
    """
    SELECT event_id, regexp_extract_all(props, '[0-9]+')[1] AS first_number,
           1 + CAST(event_type = 'click' AS BIGINT) AS shared,
           event_type IN ('click', 'view') AS overlapping,
           event_type <> 'view' AS same,
           CASE WHEN event_type = 'view' THEN 'none' ELSE event_type END AS found,
           CAST(2 AS BIGINT) AS entries,
           CASE WHEN user_id % 5 = 0 THEN '' WHEN user_id % 5 = 1 THEN '1'
                WHEN user_id % 5 = 2 THEN '1,2' WHEN user_id % 5 = 3 THEN '1,2,3'
                ELSE '1,2,3,4' END AS numbers
    FROM events
    """
)
def array_and_map_functions(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    mapping = F.create_map(kind, kind, F.lit("count"), F.col("props"))
    wanted = F.when(kind == "view", "absent").otherwise(kind)
    numbers = F.transform(fn.one_to(F.col("user_id") % 5), lambda n: n.cast("string"))
    return scan(spark, folder, "events").select(
        "event_id",
        F.get(F.regexp_extract_all("props", F.lit("[0-9]+"), F.lit(0)), F.lit(0)).alias(
            "first_number"
        ),
        fn.overlap_size(F.array(kind, F.lit("hpc")), F.array(F.lit("hpc"), F.lit("click")))
        .cast("long")
        .alias("shared"),
        fn.overlaps(F.array(kind, F.lit("x")), F.array(F.lit("click"), F.lit("view"))).alias(
            "overlapping"
        ),
        fn.same_set(
            F.array(kind, F.lit("x"), kind), F.array(F.lit("x"), F.nullif(kind, F.lit("view")))
        ).alias("same"),
        fn.get_or(mapping, wanted, F.lit("none")).alias("found"),
        F.size(F.map_keys(mapping)).cast("long").alias("entries"),
        F.concat_ws(",", numbers).alias("numbers"),
    )


@query(
    """
    WITH m AS (
      SELECT p_partkey, p_size, 'Y150N1;I' || (p_size % 9) || 'N2;N2I8;Y' || p_size || 'N1' AS mask
      FROM part)
    SELECT p_partkey, mask, CAST(8 + p_size % 9 AS BIGINT) AS index_len,
           CAST(150 + 1 + p_size % 9 + 2 + 2 + 8 + p_size + 1 AS BIGINT) AS cycles,
           (8 + p_size % 9) || '_10X' AS label,
           'SampleSheet_P1_' || (p_size % 8) || '_' || (8 + p_size % 9) || '_10X.csv' AS sheet,
           '1Y150 1N1 2I' || (p_size % 9) || ' 2N2 3N2 3I8 4Y' || p_size || ' 4N1' AS segments,
           true AS tagged
    FROM m
    """
)
def mask_parse(spark: SparkSession, folder: str) -> DataFrame:
    size = F.col("p_size")
    mask = F.concat(
        F.lit("Y150N1;I"), (size % 9).cast("string"), F.lit("N2;N2I8;Y"), size.cast("string"),
        F.lit("N1"),
    )
    label = masks.group_label(masks.index_len("mask"), F.lit("10X"))
    shown = F.transform(
        masks.mask_segments("mask"),
        lambda part: F.concat(
            part["segment"].cast("string"), part["kind"], part["len"].cast("string")
        ),
    )
    return (
        scan(spark, folder, "part")
        .select("p_partkey", size, mask.alias("mask"))
        .select(
            "p_partkey",
            "mask",
            masks.index_len("mask").cast("long").alias("index_len"),
            masks.cycles("mask").cast("long").alias("cycles"),
            label.alias("label"),
            masks.sheet_name(F.lit("P1"), size % 8, label).alias("sheet"),
            F.concat_ws(" ", shown).alias("segments"),
            fn.has_tag(label, "10X").alias("tagged"),
        )
    )
