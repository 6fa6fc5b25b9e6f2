"""Run registered queries next to their SQL checks.

``python tests/compare.py [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def rows(names, values):
    """Rows with columns by name and rows by value, types kept apart."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    listed = [tuple(repr(row[i]) for i in order) for row in values]
    return [names[i] for i in order], sorted(listed)


def spark_rows(df):
    return rows(df.columns, [tuple(row) for row in df.collect()])


def oracle_rows(connection, sql):
    result = connection.execute(sql)
    return rows([c[0] for c in result.description], result.fetchall())


def difference(left, right):
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if left[1] == right[1]:
        return None
    only_left = [r for r in left[1] if r not in set(right[1])][:3]
    only_right = [r for r in right[1] if r not in set(left[1])][:3]
    return f"{len(left[1])} != {len(right[1])} rows; spark only {only_left}; sql only {only_right}"


def main():
    import __spark_entry__ as entry
    from lanehouse.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = local_session("8", 8)
    connection = oracle(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, function in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            got = spark_rows(function(spark, folder))
            took = time.time() - start
            if name in oracles:
                start = time.time()
                problem = difference(got, oracle_rows(connection, oracles[name]))
                note = f"sql {time.time() - start:.2f}s"
            else:
                problem, note = None, "rows only"
        except Exception as error:  # a report over all queries
            problem, took, note, got = str(error)[:1500], time.time() - start, "", ([], [])
        bad += problem is not None
        print(
            f"{'FAIL' if problem else 'ok':4} {name:24} {len(got[1]):8} rows {took:6.2f}s {note} "
            f"{problem or ''}",
            flush=True,
        )
    print(f"{bad} failing of {len(wanted or queries)}")
    spark.stop()


if __name__ == "__main__":
    main()
