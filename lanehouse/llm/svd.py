"""Randomised singular value decomposition of a table of sparse rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

OVERSAMPLED, POWERS = 10, 2
#: groups of columns whose partial sums are added in one task
SUM_GROUPS = 32

PARTIAL = pa.schema(
    [("part", pa.int32()), ("columns", pa.list_(pa.int64())), ("values", pa.binary())]
)


def dense(batch: pa.RecordBatch, table: np.ndarray):
    """The product of a batch of sparse rows with ``table``, and the rows' entries."""
    columns, weights = batch.column("columns"), batch.column("weights")
    owner = np.repeat(np.arange(batch.num_rows), np.diff(columns.offsets.to_numpy()))
    column, weight = columns.flatten().to_numpy(), weights.flatten().to_numpy()
    result = np.zeros((batch.num_rows, table.shape[1]))
    np.add.at(result, owner, table[column] * weight[:, None])
    return result, owner, column, weight


def _gram_times(rows: DataFrame, table: np.ndarray) -> np.ndarray:
    """A' A ``table`` for the matrix A of ``rows``: every task adds up its rows, Spark adds the tasks' sums."""
    size = table.shape[1]

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(table)
        for batch in batches:
            product, owner, column, weight = dense(batch, table)
            np.add.at(total, column, product[owner] * weight[:, None])
        used = np.flatnonzero(total.any(axis=1))
        groups = [used[used % SUM_GROUPS == g] for g in range(SUM_GROUPS)]
        some = [g for g, own in enumerate(groups) if len(own)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some, pa.int32()),
                pa.array([groups[g] for g in some], PARTIAL.field(1).type),
                pa.array([total[groups[g]].tobytes() for g in some], pa.binary()),
            ],
            schema=PARTIAL,
        )

    def add(parts: pa.Table) -> pa.Table:
        columns = parts.column("columns").combine_chunks().flatten().to_numpy()
        values = np.frombuffer(b"".join(parts.column("values").to_pylist())).reshape(-1, size)
        distinct, place = np.unique(columns, return_inverse=True)
        total = np.zeros((len(distinct), size))
        np.add.at(total, place, values)
        row = [[parts.column("part")[0].as_py()], [distinct], [total.tobytes()]]
        return pa.Table.from_arrays(
            [pa.array(c, f.type) for c, f in zip(row, PARTIAL, strict=True)], schema=PARTIAL
        )

    schema = from_arrow_schema(PARTIAL)
    sums = rows.select("columns", "weights").mapInArrow(multiply, schema).groupBy("part").applyInArrow(add, schema)
    result = np.zeros_like(table)
    for row in sums.toLocalIterator():
        result[row["columns"]] = np.frombuffer(row["values"]).reshape(-1, size)
    return result


def right_vectors(rows: DataFrame, n_columns: int, rank: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``rank`` largest singular values of a matrix and their right vectors, as columns.

    ``rows`` has a row of the matrix each: ``columns`` (numbers below ``n_columns``) and ``weights``. A random
    start is multiplied by A' A a few times and made orthogonal, then A is decomposed in that small space. The
    driver holds ``n_columns`` times ``rank`` numbers, so columns should be a bounded vocabulary. Fewer
    vectors come back where the rank of the matrix is less.
    """
    size = min(rank + OVERSAMPLED, n_columns)
    basis = np.random.default_rng(seed).standard_normal((n_columns, size))
    for _ in range(1 + POWERS):
        basis = np.linalg.qr(_gram_times(rows, basis))[0]
    small = basis.T @ _gram_times(rows, basis)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-values)[:rank]
    order = order[values[order] > 1e-9 * max(values.max(), 1e-300)]
    return np.sqrt(values[order]), basis @ vectors[:, order]
