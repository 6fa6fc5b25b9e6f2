"""Groups and tables that are cut into parts, against whole-group results by hand."""

import json
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators import aggregates, filters, joins, levels, numbering, sets, windows
from lanehouse.plans import collect, graph, status


def hot_rows(n=500):
    """A third of the rows under one key, a few under no key."""
    rng = random.Random(1)
    keys = ["hot"] * (n // 3) + [f"k{rng.randrange(40)}" for _ in range(n // 2)] + [None] * (n // 6)
    return [(key, f"v{i:04d}", i) for i, key in enumerate(keys)]


def hot_frame(spark):
    return spark.createDataFrame(hot_rows(), "key string, value string, id long").repartition(5)


def test_values_are_numbered_within_their_key(spark):
    expected = defaultdict(list)
    for key, value, _ in hot_rows():
        expected[key].append(value)
    got = aggregates.collect_values(hot_frame(spark), ["key"], "value").collect()
    assert {(r.key, r.position): r["value"] for r in got} == {
        (key, k): value for key, values in expected.items() for k, value in enumerate(sorted(values), 1)
    }
    assert len(got) == len(hot_rows())


def test_a_key_of_many_rows_is_numbered_like_any_other(spark):
    key = F.when(F.col("id") < 200_000, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 7))
    frame = spark.range(0, 200_700, 1, 6).select(key.alias("key"), F.sha1(F.col("id").cast("string")).alias("v"))
    numbered = aggregates.collect_values(frame, ["key"], "v").cache()
    sizes = {r.key: (r.n, r.low, r.high) for r in numbered.groupBy("key").agg(
        F.count_distinct("position").alias("n"), F.min("position").alias("low"), F.max("position").alias("high")
    ).collect()}
    assert sizes == {"hot": (200_000, 1, 200_000)} | {f"k{k}": (100, 1, 100) for k in range(7)}
    hot = [r.v for r in numbered.where("key = 'hot'").orderBy("position").collect()]
    assert hot == sorted(hot)


def test_mapped_groups_merge_to_whole_groups(spark):
    seen = "key string, n long, keys long"

    def count(frame: pd.DataFrame, add: int) -> pd.DataFrame:
        row = {"key": [frame["key"].iloc[0]], "n": [len(frame) + add], "keys": [frame["key"].nunique(dropna=False)]}
        return pd.DataFrame(row)

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    for batch in ("10000", "7"):
        spark.conf.set(key, batch)
        try:
            mapped = sets.map_groups(
                hot_frame(spark), ["key"], count, seen, [F.sum("n").alias("n"), F.max("keys").alias("keys")], add=0
            ).collect()
        finally:
            spark.conf.set(key, before)
        assert {r.key: r.n for r in mapped} == Counter(k for k, _, _ in hot_rows())
        assert {r.keys for r in mapped} == {1}


@pytest.mark.parametrize("n, chunks", [(0, 3), (1, 3), (7, 3), (50, 50), (101, 10), (40, 50)])
def test_chunks_follow_ntile(spark, n, chunks):
    ids = list(range(n))
    random.Random(n).shuffle(ids)
    frame = spark.createDataFrame([(i * 3,) for i in ids], "id long").repartition(3)
    got = {r.id: r.chunk for r in numbering.chunk(frame, ["id"], chunks).collect()}
    expected, start = {}, 0
    for number in range(chunks):
        size = n // chunks + (number < n % chunks)
        expected |= {i * 3: number + 1 for i in range(start, start + size)}
        start += size
    assert got == expected


def test_positions_with_a_hot_leading_column(spark):
    rows = [("hot", i) for i in range(200)] + [(f"k{i}", i) for i in range(50)]
    frame = spark.createDataFrame(rows, "key string, id long").repartition(4)
    got = numbering.with_position(frame, ["key", "id"]).collect()
    assert [(r.key, r.id) for r in sorted(got, key=lambda r: r.position)] == sorted(rows)
    assert {r.total for r in got} == {250}


@pytest.mark.parametrize("block", [7, 1000])
def test_expansion(spark, block, monkeypatch):
    monkeypatch.setattr(sets, "EXPANSION_BLOCK", block)
    frame = spark.createDataFrame([("a", 20), ("b", 1), ("c", 0), ("d", 7), ("e", None)], "k string, n int")
    got = sorted((r.k, r.item) for r in sets.expand_by_count(frame, "n").collect())
    assert got == [("a", i) for i in range(1, 21)] + [("b", 1)] + [("d", i) for i in range(1, 8)]


def test_reports_attach_to_every_group(spark):
    groups = spark.createDataFrame([("p", 1), ("p", 2), ("q", 1)], "project string, lane int")
    reports = spark.createDataFrame([("p", 1, "r1"), ("p", 1, "r2"), ("z", 9, "r3")], "project string, lane int, report string")
    got = joins.attach_reports(groups, reports, ["project", "lane"]).collect()
    assert sorted((r.project, r.lane, r.report or "") for r in got) == [
        ("p", 1, "r1"), ("p", 1, "r2"), ("p", 2, ""), ("q", 1, ""),
    ]


def test_ordered_reports(spark):
    rows = [("g", "fastqscreen", "c"), ("g", "bclconvert", "b"), ("g", "bclconvert", "a"), ("g", "other", "x")]
    reports = spark.createDataFrame(rows, "grp string, tool string, path string")
    got = aggregates.ordered_reports(reports, ["grp"], "tool", "path").collect()
    assert sorted((r.position, r.path) for r in got) == [(1, "a"), (2, "b"), (3, "c")]


def test_report_order_of_a_large_group(spark):
    rows = [("g", tool, f"{tool}{k}") for tool in ("fastqc", "bclconvert") for k in range(6)]
    reports = spark.createDataFrame(rows, "grp string, tool string, path string").repartition(5)
    got = aggregates.ordered_reports(reports, ["grp"], "tool", "path").orderBy("position").collect()
    assert [r.path for r in got] == [f"{tool}{k}" for tool in ("bclconvert", "fastqc") for k in range(6)]


@pytest.mark.parametrize("parents", [["run"], []])
def test_levels_in_one_pass_over_any_ranges(spark, parents):
    rng = np.random.default_rng(3)
    rows = [
        (
            None if r == 2 else f"r{r}", None if p == 1 else float(p), int(lane), None if g == 0 else f"g{g}",
            {"a": int(lane)},
        )
        for r, p, lane, g in rng.integers(0, [3, 4, 3, 3], (400, 4))
        # a third of all rows under one value of all levels
    ] + [("r0", 2.0, 1, "g1", None)] * 200
    frame = spark.createDataFrame(rows, "run string, project double, lane int, grp string, note map<string,int>")
    names = {"project": "a", "lane": "b", "grp": "c"}
    order = lambda x: (x is not None, x)
    own = [r[:4] if parents else (None, *r[1:4]) for r in rows]
    expected = []
    for row, key in zip(rows, own, strict=True):
        index = []
        for level in (1, 2, 3):
            beside = sorted({o[level] for o in own if o[:level] == key[:level]}, key=order)
            index.append(beside.index(key[level]) + 1)
        expected.append((*row[:4], *index))
    for n in (1, 4, 40):
        with_partitions = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
        try:
            got = levels.indexes_within(frame, parents, names).drop("note").collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", with_partitions)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    none = levels.indexes_within(frame.limit(0), parents, names)
    assert none.collect() == [] and none.columns == [*frame.columns, "a", "b", "c"]


def test_levels_take_one_range_shuffle(spark):
    plans = []
    frame = spark.range(100).selectExpr("id % 3 AS a", "id % 5 AS b", "id % 7 AS c")
    original = levels.settle
    try:
        levels.settle = lambda df, label: plans.append(df._jdf.queryExecution().toString()) or original(df, label)
        out = levels.indexes_within(frame, ["a"], {"b": "n", "c": "m"})
    finally:
        levels.settle = original
    physical = [p.split("== Physical Plan ==")[1] for p in plans]
    assert [p.count("Exchange") for p in physical] == [1] and "rangepartitioning" in physical[0]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")


def test_indexes_within_parents(spark):
    rows = [("r", None, "x"), ("r", "p", "b"), ("r", "p", "a"), ("r", "p", "a"), ("s", "p", "z"), (None, "p", "y")]
    frame = spark.createDataFrame(rows, "run string, project string, lane string").repartition(3)
    got = windows.index_within(frame, ["run", "project"], "lane", "n").collect()
    assert sorted((str(r.run), str(r.project), r.lane, r.n) for r in got) == [
        ("None", "p", "y", 1), ("r", "None", "x", 1), ("r", "p", "a", 1), ("r", "p", "a", 1), ("r", "p", "b", 2),
        ("s", "p", "z", 1),
    ]


def test_lanes_by_the_usual_pattern(spark):
    paths = ["/x/L001/a", "/x/L008/a", "/x/L009/a", "/x/L0011/a", "/x/a", "/L002/L003/a"]
    frame = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r.path: r.lane for r in windows.lane_or_rest(frame, "path").collect()}
    rest = "additional"
    assert [got[p] for p in paths] == ["1", "8", rest, rest, rest, "2"]


def workflow(spark, *outputs):
    rows = [json.dumps({"inputs": {"sample_and_unmapped_bams": {"sample_name": f"s{k}"}}, "outputs": o}) for k, o in enumerate(outputs)]
    frame = spark.createDataFrame(list(enumerate(rows)), "id long, document string")
    return frame.select("id", fn.parse_json("document", collect.metadata_schema(["wanted", "more", "a.b c"])).alias("metadata"))


def test_a_document_without_outputs_fails_by_name(spark):
    full, other = {"wanted": "/a/b.txt", "more": "/c"}, {"wanted": None, "more": "/d"}
    good = collect.select_outputs(workflow(spark, full, full), ["id"], ["wanted"]).collect()
    assert sorted((r.id, r.sample_name, r.output, r.file) for r in good) == [
        (0, "s0", "wanted", "b.txt"), (1, "s1", "wanted", "b.txt"),
    ]
    for nothing in (other, {}, None):
        with pytest.raises((PySparkException, Py4JJavaError), match="no required file found in document 1"):
            collect.select_outputs(workflow(spark, full, nothing), ["id"], ["wanted"]).collect()
    counts = collect.outputs_per_document(workflow(spark, full, other, None), ["id"], ["wanted", "more"])
    assert sorted(tuple(r) for r in counts.collect()) == [(0, 2), (1, 1), (2, 0)]


def test_only_wanted_outputs_are_parsed(spark):
    rows = workflow(spark, {"a.b c": "/x/é.txt", "wanted": 7, "more": None, "rest": {"deep": ["x"] * 50}})
    got = collect.select_outputs(rows, ["id"], ["wanted", "more", "a.b c"]).collect()
    assert [(r.output, r.file) for r in got] == [("a.b c", "é.txt")]
    document = spark.createDataFrame([("{}",)], "d string")
    parsed = document.select(fn.parse_json("d", collect.metadata_schema()).alias("metadata"))
    outputs = parsed.schema["metadata"].dataType["outputs"].dataType
    assert len(outputs.fields) == 25 and outputs.names == list(collect.REQUIRED_OUTPUTS)
    text = spark.createDataFrame([('{"a":"x","b":1,"c":"y","d":null}',)], "d string")
    kept = text.select(fn.keep_entries(fn.parse_json("d", "map<string, variant>"), ["a", "b", "d"]).alias("m"))
    assert list(kept.first().m) == ["a"]


def test_registration_is_one_existence_join(spark, tmp_path):
    for name, rows in {"raw": [(1, "a"), (2, "b"), (None, "c"), (2, "b")], "known": [(2, "x"), (2, "y"), (None, "z")]}.items():
        spark.createDataFrame(rows, "id long, note string").write.parquet(f"{tmp_path}/{name}")
    raw, known = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("raw", "known"))
    got = status.register_new(raw, known, "id")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(
        map(repr, [(1, "a", "registered", True), (2, "b", "duplicate", True), (2, "b", "duplicate", True), (None, "c", "registered", True)])
    )
    plan = status.register_new(raw, known, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ExistenceJoin") == 1 and plan.count("FileScan parquet") == 2
    new, old = joins.split_new(raw, known, "id")
    assert (new.count(), old.count()) == (2, 2)


def test_a_repeated_sample_fails(spark, tmp_path):
    def entries(*samples):
        rows = [(json.dumps({"sample_name": s, collect.GVCF_OUTPUT: f"/x/{s}.vcf"}),) for s in samples]
        spark.createDataFrame(rows, "d string").write.mode("overwrite").parquet(str(tmp_path))
        table = spark.read.parquet(str(tmp_path))
        return collect.build_cohort_list(table.select(F.parse_json("d").alias("document")), "/f")

    assert sorted(r.gvcf for r in entries("a", "b").collect()) == ["/f/a/a.vcf", "/f/b/b.vcf"]
    with pytest.raises((PySparkException, Py4JJavaError), match="more than one entry for a sample: b"):
        entries("a", "b", "b").collect()


def test_whole_groups_come_in_order_and_in_batches(spark):
    def changed_runs(batches, base):
        """Runs of equal neighbours: depends on the order and on every row of the group."""
        key, runs, last, sizes = None, base, None, []
        for batch in batches:
            key = batch.column("key")[0].as_py()
            sizes.append(batch.num_rows)
            for value in batch.column("v").to_pylist():
                runs += value != last
                last = value
        yield pa.RecordBatch.from_pylist(
            [{"key": key, "runs": runs, "batches": len(sizes), "largest": max(sizes)}],
            pa.schema([("key", pa.string()), ("runs", pa.int64()), ("batches", pa.int64()), ("largest", pa.int64())]),
        )

    rng = random.Random(4)
    rows = [(key, k, rng.randrange(2)) for k, (key, *_) in enumerate(hot_rows(3000))]
    frame = spark.createDataFrame(rows, "key string, id long, v int").repartition(7, "v", "id")
    schema = "key string, runs long, batches long, largest long"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        mapped = sets.map_whole_groups(frame, ["key"], ["id"], changed_runs, schema, base=10)
        plan = mapped._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        assert plan.count("Sort [") == 1 and plan.count("Exchange hashpartitioning(key") == 1
        got = {r.key: r for r in mapped.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = defaultdict(list)
    for key, _, v in rows:
        expected[key].append(v)
    for key, values in expected.items():
        assert got[key].runs == 11 + sum(a != b for a, b in zip(values, values[1:], strict=False))
    assert got.keys() == expected.keys() and got["hot"].batches >= 10 and got["hot"].largest <= 100
    assert sets.map_whole_groups(frame.limit(0), ["key"], ["id"], changed_runs, schema, base=0).collect() == []


def test_slots_limit_each_group(spark):
    got = windows.slots(hot_frame(spark), ["key"], ["id"], 3).collect()
    assert max(Counter(r.key for r in got).values()) == 3
    assert sorted(r.id for r in got if r.key == "hot") == [0, 1, 2]


def test_required_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    table = spark.read.parquet(path)
    assert filters.require_rows(table.where("id > 2"), "nothing").count() == 2
    with pytest.raises((PySparkException, Py4JJavaError), match="nothing here"):
        filters.require_rows(table.where("id > 9"), "nothing here").collect()


def test_violations(spark):
    frame = spark.createDataFrame([(1, None, "x"), (2, "a", "7"), (3, "b", None)], "id int, a string, b string")
    rules = {
        "a required": filters.required("a"),
        "a allowed": filters.not_allowed("a", ["a"]),
        "b typed": filters.not_typed("b", "int"),
    }
    got = sorted(tuple(r) for r in filters.violations(frame, ["id"], rules).collect())
    assert got == [(1, "a required"), (1, "b typed"), (3, "a allowed")]


def test_status_transition(spark):
    table = spark.createDataFrame([(1, "SEEDED"), (2, "RUNNING"), (3, None), (4, "SEEDED")], "id int, status string")
    ids = spark.createDataFrame([(1,), (2,), (3,), (3,)], "id int")
    got = status.apply_transition(table, ids, "id", "status", status.ANALYSIS_RUNNING).collect()
    assert sorted((r.id, r.status, r.changed) for r in got) == [
        (1, "RUNNING", True), (2, "RUNNING", False), (3, "RUNNING", True), (4, "SEEDED", False),
    ]


def test_graph(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "c"), ("a", "b")], "src string, dst string")
    tasks = spark.createDataFrame([("a",), ("b",), ("c",)], "task string")

    def check(rows, flow):
        expected = spark.createDataFrame(rows, "task string, neighbour string")
        return {r.task: r.same for r in graph.graph_check(edges, expected, tasks, flow).collect()}

    assert check([("a", "b"), ("a", "c"), ("c", None), ("x", "y")], "downstream") == {
        "a": True, "c": True, "x": False,
    }
    assert check([("c", "a"), ("b", "a"), ("a", None)], "upstream") == {"a": True, "b": True, "c": False}
    with pytest.raises(ValueError):
        check([("a", "b")], "sideways")
    pairs = sorted(tuple(r) for r in aggregates.adjacency(edges).collect())
    assert pairs == [("a", "b"), ("a", "c"), ("b", "c")]


def test_prefix_filters(spark):
    names = spark.createDataFrame([("hpc_a",), ("_x",), ("unacked",), ("a_hpc",)], "q string")
    assert [r.q for r in filters.keep_prefix(names, "q", "hpc").collect()] == ["hpc_a"]
    kept = filters.drop_prefixes(names, "q", ["_", "unacked"])
    assert sorted(r.q for r in kept.collect()) == ["a_hpc", "hpc_a"]
    assert filters.project(names, ["q"]).columns == ["q"]


def test_unknown_group_keys_are_filled_like_any_other(spark):
    rows = [(None, 0, "a"), (None, 1, None), (None, 5, None), ("f", 1, None), ("f", 6, "b")]
    frame = spark.createDataFrame(rows, "file string, pos long, x string")
    got = windows.carry_forward(frame, ["file"], "pos", ["x"], span=2).collect()
    assert {(r.file, r.pos): r.x for r in got} == {
        (None, 0): "a", (None, 1): "a", (None, 5): "a", ("f", 1): None, ("f", 6): "b",
    }
