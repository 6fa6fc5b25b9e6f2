"""Queries that write intermediate tables, on a cluster whose session names no folder for them."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent

WRITING = (
    "admin_summary analysis_finished attached_reports capacity_plan checksum_chunks chunks_exact cleanup_idle "
    "cleanup_plan cohort_tsv collect_inputs csv_scan idle_workers job_counts job_records job_records_blocks "
    "json_sink manifest_file manifest_trees md5_files not_in_rule report_lines retention_candidates "
    "retention_in_place retention_counts retention_plan retention_survivors sheet_groups_map sheet_index "
    "sheet_tasks snapshot_backup snapshot_replace status_transition sync_in_place task_expansion "
    "task_expansion_array tool_order worker_branches"
).split()


@pytest.fixture(scope="module")
def said(sf_dir, tmp_path_factory):
    """What a run in a process of its own says, as the session of the other tests has one process."""
    at = tmp_path_factory.mktemp("cluster")
    (at / "conf").mkdir()
    env = os.environ | {"SPARK_CONF_DIR": str(at / "conf"), "SPARK_LOCAL_IP": "127.0.0.1"}
    run = subprocess.run(
        [sys.executable, HERE / "on_cluster.py", os.path.abspath(sf_dir), *WRITING],
        cwd=at,
        env=env,
        capture_output=True,
        text=True,
        timeout=900,
    )
    assert run.returncode == 0, run.stderr[-2000:]
    return dict(json.loads(line) for line in run.stdout.splitlines() if line.startswith("["))


@pytest.mark.parametrize("name", WRITING)
def test_a_query_runs_without_a_named_folder(said, name):
    assert said[name] is None


def test_a_disk_is_taken_only_where_executors_see_it(said):
    assert said["seen"] == [True, True, False]
    assert "set spark.checkpoint.dir" in said["refused"] and said["named"]
    assert said["warehouse"].endswith("/warehouse/lanehouse-work")
