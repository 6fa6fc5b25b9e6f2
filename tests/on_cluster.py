"""Run queries on executors of their own, in a session that names no folder for intermediate tables.

``python tests/on_cluster.py folder name ...`` prints a JSON line per query: its name and what differs from its
SQL. The first line has what ``seen_by_executors`` says of a shared folder and of one that each process has.
"""

from __future__ import annotations

import json
import os
import sys
from pathlib import Path

from compare import difference, oracle, oracle_rows, spark_rows
from pyspark.sql import SparkSession

TOP = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, TOP)


def main():
    import __spark_entry__ as entry
    from lanehouse import session

    folder, *names = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local-cluster[2,2,1200]")
        .config("spark.executor.memory", "1g")
        .config("spark.executorEnv.PYTHONPATH", TOP)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", os.path.abspath("warehouse"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared, own = os.path.abspath("shared"), "/proc/self/cwd/own"
    print(json.dumps(["seen", [session.seen_by_executors(spark, x) for x in (shared, f"file://{shared}", own)]]))
    print(json.dumps(["warehouse", session.work_folder(spark)]))
    connection = oracle(folder)
    for name in names:
        try:
            got = spark_rows(entry.queries()[name](spark, folder))
            problem = difference(got, oracle_rows(connection, entry.oracle_sql()[name]))
        except Exception as error:  # a line for every query
            problem = " ".join(str(error).split())[:500]
        print(json.dumps([name, problem]), flush=True)
    session.on_one_machine = lambda _: False
    spark.sparkContext.setCheckpointDir(own)
    try:
        print(json.dumps(["refused", session.work_folder(spark)]))
    except RuntimeError as error:
        print(json.dumps(["refused", str(error)]))
    spark.sparkContext.setCheckpointDir(shared)
    print(json.dumps(["named", session.work_folder(spark).startswith(f"file:{shared}/")]))
    spark.stop()


if __name__ == "__main__":
    main()
