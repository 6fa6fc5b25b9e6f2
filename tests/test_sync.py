import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators.joins import update_tracked
from lanehouse.plans import sync
from lanehouse.sources import keyed, writers

SCHEMA = "id long, status string, at string"


def frame(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def target(spark, *rows):
    return frame(spark, *rows).withColumn("at", fn.normalise_ts("at"))


def run(spark, source, target_rows):
    result = sync.incremental_sync(
        frame(spark, *source), target(spark, *target_rows), "id", ["id", "status", "at"], ["at"], "status"
    )
    return {row.id: (row.status, None if row.at is None else str(row.at)) for row in result.collect()}


def test_key_zero_never_enters_an_empty_target(spark):
    got = run(spark, [(0, "A", "2024-01-01T10:00:00.000000Z"), (1, "B", "2024-01-02T10:00:00.000000Z")], [])
    assert got == {1: ("B", "2024-01-02 10:00:00")}


def test_late_low_keys_stay_out_and_changes_are_taken(spark):
    source = [(1, "A", "x"), (2, "B", "x"), (3, "C", "2024-01-03T00:00:00"), (4, "D", "bad")]
    got = run(spark, source, [(2, "old", "2024-01-01T00:00:00")])
    assert got == {
        2: ("B", "2024-01-01 00:00:00"),
        3: ("C", "2024-01-03 00:00:00"),
        4: ("D", None),
    }


def test_null_on_either_side_is_no_change(spark):
    source = [(1, None, "x"), (2, "B", "x"), (3, "B", "x")]
    got = run(spark, source, [(1, "A", "x"), (2, None, "x"), (3, "B", "x")])
    assert {k: v[0] for k, v in got.items()} == {1: "A", 2: None, 3: "B"}


def test_rows_gone_from_the_source_stay(spark):
    assert run(spark, [], [(5, "A", "x")]) == {5: ("A", None)}


def test_repeated_source_key_fails(spark):
    source = frame(spark, (1, "A", "x"), (1, "B", "x"))
    with pytest.raises(PySparkException, match="source repeats id 1"):
        update_tracked(target(spark, (1, "C", "x")), source, "id", "status").collect()


def test_specs_project_their_columns(spark):
    rows = [(1, "U1", "n", "e", "ACTIVE", "dropped")]
    source = spark.createDataFrame(rows, [*sync.USER.columns, "more"])
    empty = source.where("false").drop("more")
    got = sync.sync_table(sync.USER, source, empty)
    assert got.columns == list(sync.USER.columns)
    assert got.count() == 1


def files_of(path):
    return {str(p): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_only_touched_ranges_are_written_again(spark, tmp_path):
    columns = ("id", "status", "at")
    spec = sync.SyncedTable("s", "t", "id", columns, ("at",), "status")
    path = tmp_path / "table"
    rows = [(k, "A", "2024-01-01T00:00:00") for k in range(1, 101)] + [(None, "N", None), (-3, None, None)]
    before = target(spark, *rows)
    keyed.write_keyed(before, str(path), "id", 10)
    old = files_of(path)
    # one change, one value that is known to neither, a key from below and a load that begins in the last range
    source = [(k, "A", "x") for k in range(1, 101)]
    source[34] = (35, "B", "x")
    source[49] = (50, None, "x")
    source += [(-3, "X", "x"), (103, "C", "2024-01-02T00:00:00"), (115, "D", None)]
    touched = sync.sync_in_place(spec, frame(spark, *source), str(path), before.schema, 10)
    assert touched == [3, 10, 11]
    new = files_of(path)
    kept = {p for p in old if not any(f"key_range={k}/" in p for k in (3, 10, 11))}
    assert len(kept) == len(old) - 2 and all(new.get(p) == old[p] for p in kept)
    got = keyed.read_keyed(spark, str(path), before.schema).drop("key_range")
    expected = sync.sync_table(spec, frame(spark, *source), before)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
    # a second run finds nothing to do
    assert sync.sync_in_place(spec, frame(spark, *source), str(path), before.schema, 10) == []
    assert files_of(path) == new


def test_named_ranges_are_read_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    before = target(spark, *[(k, "A", None) for k in range(1, 40)])
    keyed.write_keyed(before, path, "id", 10)
    one = keyed.read_keyed(spark, path, before.schema).where(F.col(keyed.RANGE).isin([1, 3]))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_range" in plan
    assert sorted(r.id for r in one.collect()) == [*range(10, 20), *range(30, 40)]


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS b_source")
    spark.sql("DROP TABLE IF EXISTS b_target")
    rows = frame(spark, *[(i, "A", "x") for i in range(100)])
    writers.bucketed_snapshot(rows, "b_source", "id", 4, str(tmp_path / "s"))
    writers.bucketed_snapshot(rows, "b_target", "id", 4, str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = update_tracked(spark.table("b_target"), spark.table("b_source"), "id", "status")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert joined.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE b_source")
        spark.sql("DROP TABLE b_target")
