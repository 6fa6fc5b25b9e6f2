import datetime as dt

from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators.joins import anti_not_in
from lanehouse.plans import retention
from lanehouse.sources import dated

DAY = [dt.datetime(2024, 1, d) for d in range(1, 29)]
RUNS = "dag_id string, execution_date timestamp_ntz, external_trigger boolean"


def cutoff(day):
    return F.lit(DAY[day - 1]).cast("timestamp_ntz")


def runs(spark, *rows):
    return spark.createDataFrame([(g, None if d is None else DAY[d - 1], e) for g, d, e in rows], RUNS)


def days(df):
    """Group and day of each row, day 0 for no date."""
    return sorted((r.dag_id, r.execution_date.day if r.execution_date else 0) for r in df.collect())


def split(spark, table, day):
    kept = retention.kept_instants(table)
    gone = retention.candidates(table, "execution_date", cutoff(day), kept)
    left = retention.survivors(table, "execution_date", cutoff(day), kept)
    return days(gone), days(left)


def test_only_the_instant_is_compared(spark):
    table = runs(spark, ("a", 1, False), ("a", 2, False), ("b", 2, False), ("b", 3, False), ("c", 1, True))
    gone, left = split(spark, table, 10)
    assert gone == [("a", 1), ("c", 1)]
    assert left == [("a", 2), ("b", 2), ("b", 3)]


def test_external_runs_do_not_keep_themselves(spark):
    table = runs(spark, ("a", 1, False), ("a", 5, True), ("a", 6, None))
    assert split(spark, table, 10) == ([("a", 5), ("a", 6)], [("a", 1)])


def test_cutoff_is_inclusive_and_missing_age_stays(spark):
    table = runs(spark, ("a", 9, True), ("a", 10, True), ("a", 11, True), ("a", None, True), ("z", 20, False))
    gone, left = split(spark, table, 10)
    assert gone == [("a", 9), ("a", 10)]
    assert left == [("a", 0), ("a", 11), ("z", 20)]


def test_one_unknown_last_run_keeps_everything(spark):
    table = runs(spark, ("a", 1, False), ("a", 2, False), ("b", None, False))
    gone, left = split(spark, table, 10)
    assert gone == [] and len(left) == 3


def test_no_group_and_no_runs(spark):
    table = runs(spark, ("a", 1, True))
    none = retention.last_per_group(table, "execution_date", [fn.is_false("external_trigger")])
    assert days(retention.candidates(table, "execution_date", cutoff(10), none)) == []
    grouped = retention.kept_instants(table)
    assert days(retention.candidates(table, "execution_date", cutoff(10), grouped)) == [("a", 1)]


def test_not_in_with_null_columns(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    values = spark.createDataFrame([(1,)], "y int")
    assert [r.x for r in anti_not_in(left, "x", values, "y").collect()] == [2]
    assert anti_not_in(left, "x", values.where("y > 5"), "y").count() == 3
    with_null = values.unionByName(spark.createDataFrame([(None,)], "y int"))
    assert anti_not_in(left, "x", with_null, "y").count() == 0


def test_cleanup_skips_missing_tables_and_defaults_the_age(spark):
    table = runs(spark, ("a", 1, False), ("a", 2, False), ("b", 28, False))
    now = F.lit(dt.datetime(2024, 2, 10)).cast("timestamp_ntz")
    plan = retention.retention_cleanup({"DagRun": table}, now, 0)
    assert list(plan) == ["DagRun"]
    part = plan["DagRun"]
    assert days(part.candidates()) == [("a", 1)]
    assert days(part.survivors()) == [("a", 2), ("b", 28)]


def test_each_table_has_its_own_rule_and_instants_are_written_once(spark, monkeypatch):
    table = runs(spark, ("a", 1, False), ("a", 2, True), ("b", 3, False), ("b", 4, False))
    flat = retention.KeepLast("Log", "execution_date")
    specs = [
        retention.AgedTable("DagRun", "execution_date", retention.LAST_RUNS),
        retention.AgedTable("XCom", "execution_date", retention.LAST_RUNS),
        retention.AgedTable("Log", "execution_date", flat),
        retention.AgedTable("Task", "execution_date"),
    ]
    written = []
    settle = retention.settle
    monkeypatch.setattr(retention, "settle", lambda df, label: written.append(label) or settle(df, label))
    now = F.lit(dt.datetime(2024, 3, 10)).cast("timestamp_ntz")
    plan = retention.retention_cleanup(dict.fromkeys(("DagRun", "XCom", "Log", "Task"), table), now, 30, specs)
    assert written == ["kept", "kept"]
    gone = {name: days(part.candidates()) for name, part in plan.items()}
    assert gone["DagRun"] == gone["XCom"] == [("a", 2), ("b", 3)]
    assert gone["Log"] == [("a", 1), ("a", 2), ("b", 3)]
    assert len(gone["Task"]) == 4
    assert written == ["kept", "kept"]
    assert days(plan["Log"].survivors()) == [("b", 4)]


def test_project_stages_only_move_forward(spark):
    projects = spark.createDataFrame(
        [(i, s) for i, s in enumerate(retention.STAGES)] + [(9, "active")], "id int, stage string"
    )
    activity = spark.createDataFrame([(i, DAY[0]) for i in range(4)] + [(9, DAY[20])], "id int, ts timestamp_ntz")
    got = retention.project_cleanup(projects, activity, "id", "ts", cutoff(10))
    stages = {r.id: r.next_stage for r in got.collect()}
    assert stages == {0: "candidate", 1: "notified", 2: "deleted", 3: "deleted", 9: "active"}


def files_of(path):
    return {str(p): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def dated_table(spark, path):
    hours = [(f"g{d % 3}", DAY[d - 1] + dt.timedelta(hours=h), h == 5) for d in range(1, 15) for h in (1, 5, 20)]
    table = spark.createDataFrame([*hours, ("g9", None, False)], RUNS)
    dated.write_dated(table, str(path), "execution_date")
    return table


def test_aged_days_leave_as_folders(spark, tmp_path):
    path = tmp_path / "t"
    table = dated_table(spark, path)
    limit = F.lit(DAY[9] + dt.timedelta(hours=5)).cast("timestamp_ntz")
    runs_of = table.where("execution_date < timestamp_ntz'2024-01-09'")
    kept = retention.kept_instants(runs_of, "execution_date", [fn.is_false("external_trigger")], ["dag_id"])
    expected = retention.survivors(table, "execution_date", limit, kept)
    counted = retention.delete_counts(t=retention.candidates(table, "execution_date", limit, kept)).first().n
    old = files_of(path)
    assert dated.drop_aged(spark, str(path), table.schema, "execution_date", limit, kept) == counted > 20
    got = dated.read_dated(spark, str(path), table.schema).drop("day")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
    # days 6, 7 and 8 hold a last run and day 10 the cutoff; later days and the one without a date stay
    new = files_of(path)
    days = sorted(p.name.removeprefix("day=2024-01-") for p in path.iterdir() if p.name.startswith("day=2024"))
    assert days == ["06", "07", "08", "10", "11", "12", "13", "14"]
    outside = [p for p in old if any(f"2024-01-{d}/" in p for d in (11, 12, 13, 14)) or "HIVE" in p]
    assert len(outside) == 5 and all(new.get(p) == old[p] for p in outside)
    assert dated.drop_aged(spark, str(path), table.schema, "execution_date", limit, kept) == 0
    assert files_of(path) == new


def test_an_unknown_last_run_keeps_all_folders(spark, tmp_path):
    table = dated_table(spark, tmp_path / "t")
    old = files_of(tmp_path / "t")
    kept = spark.createDataFrame([(DAY[0],), (None,)], "last timestamp_ntz")
    args = (str(tmp_path / "t"), table.schema, "execution_date")
    assert dated.drop_aged(spark, *args, cutoff(20), kept) == 0
    assert files_of(tmp_path / "t") == old
    assert dated.drop_aged(spark, *args, cutoff(20)) == 42
    assert dated.read_dated(spark, str(tmp_path / "t"), table.schema).count() == 1


def test_aged_days_are_counted_without_a_column(spark, tmp_path):
    table = dated_table(spark, tmp_path / "t")
    read = dated.read_dated(spark, str(tmp_path / "t"), table.schema)
    days = read.where(F.col("day").isin([DAY[0].date(), DAY[2].date()])).groupBy().count()
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan and "PartitionFilters: [day" in plan
