from lanehouse.plans import capacity
from lanehouse.streaming import poll


def test_each_poll_lands_new_reports_only(spark, tmp_path):
    reports, table, progress = (str(tmp_path / name) for name in ("reports", "lines", "progress"))
    (tmp_path / "reports").mkdir()

    def run():
        poll.land(poll.report_stream(spark, reports), table, progress)
        records = capacity.job_records(spark.read.parquet(table), ["file"], span=None)
        return sorted((r.job_id, r.job_name, r.job_state) for r in records.collect())

    first = "Job Id: 1\n Job_Name = hpc_a\n job_state = R\n"
    (tmp_path / "reports" / "one.txt").write_text(first)
    assert run() == [("1", "hpc_a", "R")]
    (tmp_path / "reports" / "two.txt").write_text("Job Id: 2\n Job_Name = hpc_b\n job_state = Q\n")
    assert run() == [("1", "hpc_a", "R"), ("2", "hpc_b", "Q")]
    assert run() == [("1", "hpc_a", "R"), ("2", "hpc_b", "Q")]
