import base64
import hashlib
import json
import os
import subprocess
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lanehouse import session
from lanehouse.operators import numbering
from lanehouse.plans import manifest
from lanehouse.sources import digests, readers, tree, writers


def test_line_scan_keeps_order_per_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\nthree\n")
    (tmp_path / "b.txt").write_text("x")
    got = readers.line_scan(spark, str(tmp_path)).collect()
    lines = sorted((r.file.rsplit("/", 1)[1], r.pos, r.line) for r in got)
    assert lines == [("a.txt", 0, "one"), ("a.txt", 1, ""), ("a.txt", 2, "three"), ("b.txt", 0, "x")]


def test_split_line_scan_orders_lines_over_splits(spark, tmp_path):
    text = [f"line {i}" for i in range(5000)]
    (tmp_path / "big.txt").write_text("\n".join(text) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = readers.split_line_scan(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len({r.block for r in got}) > 5
    assert [r.line for r in sorted(got, key=lambda r: (r.block, r.pos))] == text


def test_json_and_csv(spark, tmp_path):
    (tmp_path / "dump.json").write_text(json.dumps({"Jobs": {"7": {"Job_Name": "hpc", "job_state": "R"}}}, indent=1))
    dump = readers.json_scan(spark, str(tmp_path / "dump.json"), readers.JOB_DUMP, multiline=True)
    assert dump.select(F.explode("Jobs")).first().value.Job_Name == "hpc"
    (tmp_path / "lines.json").write_text('{"Jobs":{"1":{"Job_Name":"a"}}}\n{"Jobs":{"2":{"Job_Name":"b"}}}\n')
    assert readers.json_scan(spark, str(tmp_path / "lines.json"), readers.JOB_DUMP).count() == 2
    (tmp_path / "pools.csv").write_text("pool_name,slots\ndefault_pool,50\n")
    assert tuple(readers.csv_scan(spark, str(tmp_path / "pools.csv"), readers.POOLS).first()) == ("default_pool", 50)


def test_second_write_fails(spark, tmp_path):
    rows = spark.createDataFrame([("s1", "/x/a.vcf")], "sample string, gvcf string")
    path = str(tmp_path / "list")
    writers.tsv_sink(rows, path)
    assert spark.read.text(path).first().value == "s1\t/x/a.vcf"
    with pytest.raises(PySparkException):
        writers.tsv_sink(rows, path)


@pytest.mark.parametrize("piece_bytes", [1 << 24, 2])
def test_digests_of_files(spark, tmp_path, piece_bytes):
    folder = tmp_path / "results"
    (folder / "deep").mkdir(parents=True)
    (folder / "a.txt").write_text("alpha")
    (folder / "deep" / "b.txt").write_text("b")
    (folder / readers.MANIFEST_NAME).write_text("old")
    got = digests.file_md5(spark, str(folder), piece_bytes).collect()
    assert sorted((r.path, r.md5, r.length) for r in got) == [
        ("results/a.txt", hashlib.md5(b"alpha").hexdigest(), 5),
        ("results/deep/b.txt", hashlib.md5(b"b").hexdigest(), 1),
    ]


def test_a_tree_is_what_find_gives(spark, tmp_path):
    top = tmp_path / "run 1%20"
    for name in ("a/b/c/d/deep", "a/b", "empty", "é x"):
        (top / name).mkdir(parents=True, exist_ok=True)
    for name, data in {
        "zero.log": b"", "a/b/c/d/deep/zero": b"", "a/b/_SUCCESS": b"", "a/.hidden": b"h", "é x/one two.txt": b"12",
        readers.MANIFEST_NAME: b"old",
    }.items():
        (top / name).write_bytes(data)
    (top / "a" / "again").symlink_to(top)
    (top / "a" / "link").symlink_to(top / "zero.log")
    found = subprocess.run(["find", top, "-type", "f"], capture_output=True, text=True, check=True).stdout
    expected = {p for p in found.splitlines() if not p.endswith(readers.MANIFEST_NAME)}
    got = tree.file_tree(spark, str(top)).collect()
    assert {r.path for r in got} == expected and len(got) == len(expected) == 5
    assert {r.path: r.length for r in got} == {p: os.path.getsize(p) for p in expected}
    digest = {r.path: r.md5 for r in digests.file_md5(spark, str(top)).collect()}
    assert digest["run 1%20/zero.log"] == hashlib.md5(b"").hexdigest()
    assert digest["run 1%20/é x/one two.txt"] == hashlib.md5(b"12").hexdigest()
    assert tree.file_tree(spark, str(top / "empty")).collect() == []
    with pytest.raises(PySparkException):
        tree.file_tree(spark, str(top / "none")).collect()


def test_a_file_per_row(spark, tmp_path):
    rows = spark.createDataFrame([("a/x.txt", "é\n"), ("b", ""), ("c", None)], "name string, body string")
    writers.file_per_row(rows, str(tmp_path), "name", "body")
    writers.file_per_row(rows, str(tmp_path), "name", "body")
    left = {str(p.relative_to(tmp_path)): p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()}
    assert left == {"a/x.txt": "é\n".encode(), "b": b""}


def test_manifest_lines(spark, tmp_path):
    rows = spark.createDataFrame([("d" * 32, "results/a  b.txt")], "md5 string, path string")
    path = str(tmp_path / "m")
    writers.manifest_sink(rows, path)
    assert spark.read.text(path).first().value == "d" * 32 + "  results/a  b.txt"
    assert tuple(manifest.manifest_read(spark, path).first()) == ("d" * 32, "results/a  b.txt")


def test_work_folder_is_the_one_of_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.work_folder(spark)
    assert folder == named if named else folder.startswith("/tmp")
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_a_job_leaves_no_files(spark):
    root = Path(session.work_folder(spark).removeprefix("file://"))
    with session.job(spark) as folder:
        with session.job(spark) as inner:
            assert session.settle(spark.range(9), "x").count() == 9
            assert os.listdir(inner.removeprefix("file://"))
        assert not Path(inner.removeprefix("file://")).exists()
        chunks = numbering.chunk(spark.range(100).toDF("id"), ["id"], 3)
        assert chunks.count() == 100 and len(os.listdir(folder.removeprefix("file://"))) == 1
    assert not [p for p in os.listdir(root) if p.startswith("job-")]
    with pytest.raises(ZeroDivisionError), session.job(spark) as folder:
        session.settle(spark.range(1), "x")
        1 / 0
    assert not Path(folder.removeprefix("file://")).exists()


def test_a_local_folder_is_refused_on_a_cluster(spark, monkeypatch):
    for folder in ("file:///tmp/x", "file:/tmp/x", "/tmp/x", "x"):
        assert session.on_local_disk(folder, "file:///")
    for folder in ("hdfs://host/x", "s3a://bucket/a:b"):
        assert not session.on_local_disk(folder, "file:///")
    assert not session.on_local_disk("/shared/a:b", "hdfs://host:8020")
    monkeypatch.setattr(session, "is_local", lambda _: False)
    monkeypatch.setattr(session, "on_one_machine", lambda _: False)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_folder(spark)


def test_a_failing_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.snapshot_replace(spark.range(10), path)
    bad = spark.range(1000).select(F.when(F.col("id") == 999, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    for write in (writers.snapshot_replace, writers.append):
        with pytest.raises(PySparkException, match="stop"):
            write(bad, path)
        assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(10))
    # the table may be read for its own replacement
    writers.snapshot_replace(spark.read.parquet(path).where("id < 4"), path)
    writers.append(spark.range(20, 22), path + "/")
    assert sorted(r.id for r in writers.snapshot_scan(spark, path).collect()) == [0, 1, 2, 3, 20, 21]
    assert sorted(os.listdir(tmp_path)) == ["t"]


def test_a_replacement_that_was_lost_between_its_renames(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.snapshot_replace(spark.range(3), path)
    os.rename(path, path + writers.LAST)
    spark.range(9).write.parquet(path + writers.NEXT)
    assert writers.snapshot_scan(spark, path).count() == 3
    with pytest.raises(PySparkException, match="stop"):
        writers.snapshot_replace(spark.range(5).select(F.raise_error(F.lit("stop")).alias("id")), path)
    # the old table is back in its place, and the next run replaces it
    assert spark.read.parquet(path).count() == 3
    writers.snapshot_replace(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7 and sorted(os.listdir(tmp_path)) == ["t"]


def test_only_one_process_is_local(spark, monkeypatch):
    class Context:
        pass

    class Session:
        sparkContext = Context()

    for master, local in {"local": 1, "local[4]": 1, "local[*]": 1, "local-cluster[3,2,1024]": 0, "yarn": 0}.items():
        Context.master = master
        assert session.is_local(Session) == bool(local)
        assert session.on_one_machine(Session) == master.startswith("local")


def test_old_snapshots_are_removed_whole(spark, tmp_path):
    path = str(tmp_path / "backup")
    for day in ("2024-01-03", "2024-01-01", "2024-01-02"):
        writers.snapshot_backup(spark.range(3), path, day)
    (tmp_path / "backup" / "notes").mkdir()
    with pytest.raises(ValueError):
        writers.prune_snapshots(spark, path, 0)
    assert writers.prune_snapshots(spark, path, 2) == ["2024-01-01"]
    assert writers.prune_snapshots(spark, path, 2) == []
    left = sorted(p.name for p in (tmp_path / "backup").iterdir() if p.is_dir())
    assert left == ["notes", "snapshot_date=2024-01-02", "snapshot_date=2024-01-03"]
    assert spark.read.parquet(path).count() == 6


def test_queue_documents(spark):
    counts = base64.b64encode(b' {"hpc_a": {"Q": 1, "R": 2}, "hpc_b": {}}\n').decode()
    got = readers.active_counts(spark.createDataFrame([(counts,)], "value string")).collect()
    assert sorted(tuple(r) for r in got) == [("hpc_a", "Q", 1), ("hpc_a", "R", 2)]
    waiting = spark.createDataFrame([('[{"a": 3}, {"b": 0}]',)], "value string")
    assert [tuple(r) for r in readers.waiting_list(waiting).collect()] == [("a", 3), ("b", 0)]


def test_worker_list(spark):
    reply = {"w1": {"active": [{"id": "1", "name": "t"}], "active_queues": [{"name": "generic"}]}, "w2": {"active_queues": []}}
    documents = spark.createDataFrame([(json.dumps(reply),)], "value string")
    got = {r.worker_id: (r.active_jobs, r.queues) for r in readers.worker_list(documents).collect()}
    assert got == {"w1": (1, ["generic"]), "w2": (0, [])}
