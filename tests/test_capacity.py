import random

import pytest

from lanehouse.operators import aggregates
from lanehouse.plans import capacity

ACTIVE = "cluster string, queue string, state string, n long"
WAITING = "cluster string, queue string, waiting long"


def by_hand(waiting, active, per_queue, total_cap):
    """The admission rule, one cluster at a time."""
    admitted = {}
    for cluster in {c for c, _, _ in waiting}:
        counts = [(q, s, n) for c, q, s, n in active if c == cluster and s in "QR"]
        total = sum(n for _, _, n in counts)
        for queue, number in sorted((q, n) for c, q, n in waiting if c == cluster):
            running = sum(n for q, _, n in counts if q == queue)
            if any(q == queue and s == "Q" and n > 0 for q, s, n in counts):
                continue
            size = min(number, per_queue)
            if running and size > running:
                size -= running
            if total + size < total_cap:
                admitted[cluster, queue] = size
                total += size if running else 0
    return admitted


def planned(spark, waiting, active, per_queue=10, total_cap=70):
    plan = capacity.capacity_plan(
        spark.createDataFrame(waiting, WAITING),
        spark.createDataFrame(active, ACTIVE),
        per_queue_cap=per_queue,
        total_cap=total_cap,
    )
    return {(r.cluster, r.queue): r.new_tasks for r in plan.collect()}


@pytest.mark.parametrize("seed", range(6))
def test_plan_follows_the_rule(spark, seed):
    rng = random.Random(seed)
    waiting, active = [], []
    per_queue, total_cap = rng.choice([(10, 70), (3, 12), (10, 25), (1, 5)])
    for cluster in "abcdefgh":
        for queue in range(rng.choice([3, 30, 80])):
            name = f"hpc_{queue:03d}"
            waiting.append((cluster, name, rng.choice([0, 1, 2, 5, 9, 10, 11, 40])))
            for state in rng.choice(["", "", "R", "R", "Q", "F", "RF", "RQ"]):
                active.append((cluster, name, state, rng.choice([0, 1, 1, 2, 12])))
    assert planned(spark, waiting, active, per_queue, total_cap) == by_hand(
        waiting, active, per_queue, total_cap
    )


def test_plan_cases(spark):
    waiting = [
        ("c", "q1", 50),  # above the cap per queue, no jobs
        ("c", "q2", 9),  # a queued job
        ("c", "q3", 3),  # not more waiting than running
        ("c", "q4", 9),  # more waiting than running
        ("full", "q1", 1),
        ("edge", "q1", 10),
        ("edge", "q2", 9),
    ]
    active = [
        ("c", "q2", "Q", 1), ("c", "q3", "R", 4), ("c", "q4", "R", 2), ("c", "q4", "F", 90),
        ("full", "other", "R", 70), ("edge", "other", "Q", 60),
    ]
    assert planned(spark, waiting, active) == {
        ("c", "q1"): 10, ("c", "q3"): 3, ("c", "q4"): 7, ("edge", "q2"): 9,
    }


def test_no_jobs_anywhere(spark):
    assert planned(spark, [("c", "q", 4)], []) == {("c", "q"): 4}
    assert planned(spark, [], [("c", "q", "R", 4)]) == {}


def test_job_counts_need_prefix_and_state(spark):
    jobs = spark.createDataFrame(
        [("hpc_a", "Q"), ("hpc_a", "R"), ("hpc_a", "R"), ("hpc_b", "F"), ("x_hpc", "R")],
        "job_name string, job_state string",
    )
    got = [tuple(r) for r in aggregates.job_counts(jobs, "hpc").collect()]
    assert got == [("hpc_a", 1, 2)]


def test_idle_workers_and_branches(spark):
    workers = spark.createDataFrame(
        [
            ("free", 0, ["hpc_x"]), ("busy", 1, ["hpc_x"]), ("base", 0, ["generic", "hpc_x"]),
            ("wanted", 0, ["hpc_x", "hpc_a"]), ("none", 0, []),
        ],
        "worker_id string, active_jobs long, queues array<string>",
    )
    waiting = spark.createDataFrame(
        [("c", "hpc_a", 3), ("c", "local", 2), ("c", "hpc_z", 99), ("d", "hpc_a", 1)],
        "cluster string, queue string, waiting long",
    )
    active = spark.createDataFrame(
        [("c", "hpc_z", "Q", 1), ("c", "hpc_y", "R", 2)], "cluster string, queue string, state string, n long"
    )
    conf = spark.createDataFrame([("hpc_a", "r1"), ("hpc_z", "r2")], "queue string, pbs_resource string")
    idle, branches, plan = capacity.worker_cleanup(workers, waiting, active, conf)
    assert sorted(r.worker_id for r in idle.collect()) == ["free", "none"]
    assert sorted(r.branch for r in branches.collect()) == ["cleanup_celery_workers", "hpc_a"]
    assert sorted((r.cluster, r.queue, r.new_tasks, r.pbs_resource) for r in plan.collect()) == [
        ("c", "hpc_a", 3, "r1"), ("d", "hpc_a", 1, "r1"),
    ]
    quiet = capacity.worker_cleanup(workers.where("worker_id = 'busy'"), waiting, active, conf)
    assert [r.branch for r in quiet.branches.collect()] == ["hpc_a"]
    full = capacity.worker_cleanup(workers, waiting, active, conf, total_cap=1)
    assert [r.branch for r in full.branches.collect()] == ["cleanup_celery_workers"]
    assert full.plan.isEmpty()


def test_task_expansion(spark):
    plan = spark.createDataFrame(
        [("a", 3), ("b", 1), ("c", 0), ("unknown", 5)], "queue string, new_tasks long"
    )
    conf = spark.createDataFrame([("a", "r"), ("b", "r"), ("c", "r")], "queue string, pbs_resource string")
    tasks = capacity.task_expansion(plan, conf).collect()
    assert sorted((r.queue, r.task) for r in tasks) == [("a", 1), ("a", 2), ("a", 3), ("b", 1)]
    arrays = capacity.task_expansion(plan, conf, capacity.ARRAY_MODE).collect()
    assert sorted(r.queue for r in arrays) == ["a", "b", "c"]


def test_private_queues_are_left_out(spark):
    messages = spark.createDataFrame([("_x",), ("unacked_y",), ("a",), ("a",)], "queue string")
    assert [tuple(r) for r in aggregates.queue_depth(messages).collect()] == [("a", 2)]


def test_last_entry_of_a_queue_wins(spark):
    entries = spark.createDataFrame([("a", 1, 10), ("a", 2, 5), ("b", 1, 7)], "queue string, nth int, n int")
    got = {r.queue: r.n for r in aggregates.unique_queues(entries, "n", "nth").collect()}
    assert got == {"a": 5, "b": 7}
