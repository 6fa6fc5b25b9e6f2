"""Numbers of nested values, found in one sorted pass over ranges of rows."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from lanehouse.operators.numbering import ROW_BITS
from lanehouse.session import settle

PLACE = ("_row", "_edge", "_lead")


def changes(columns: Sequence[pa.Array]) -> np.ndarray:
    """For each row but the first, the first of ``columns`` that differs from the row before; NULL equals NULL."""
    depth = np.full(len(columns[0]) - 1, len(columns))
    for k in range(len(columns) - 1, -1, -1):
        codes = columns[k].dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        depth[codes[1:] != codes[:-1]] = k
    return depth


def counted(fresh: np.ndarray, steps: np.ndarray, before: int) -> np.ndarray:
    """Running count of ``steps``, from 1 where ``fresh`` is set and going on from ``before`` until then."""
    total = np.cumsum(steps & ~fresh)
    at = np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), -1))
    return np.where(at >= 0, total - total[at] + 1, before + total)


def indexes_within(df: DataFrame, parents: Sequence[str], levels: Mapping[str, str]) -> DataFrame:
    """Ours: number the distinct values of each column of ``levels``, from 1 in their order.

    The values of the first column are numbered within ``parents``, those of the next one within them and the
    first, and so on. The rows are sorted once by all of them in ranges, and every range numbers the changes
    it sees, for all levels in one pass; rows in the groups that were open where it begins are marked. Its
    first and last row tell, one range after the other, what the next one goes on from. Equal rows are told
    apart by a hash, so neither a parent nor a value with many rows is one task.
    """
    names, keys = list(levels), [*parents, *levels]
    kinds = [df.schema[c] for c in df.columns]
    added = [
        *(StructField(f"_at{k}", LongType()) for k in range(len(names))),
        StructField("_row", LongType()),
        StructField("_edge", BooleanType()),
        StructField("_lead", IntegerType()),
    ]
    first_level = len(parents)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at, lead, row = None, [0] * len(names), len(keys), 0
        waiting: list | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = [batch.column(c) for c in keys]
            if last is None:
                depth = np.concatenate([[0], changes(own)])
            else:
                # the row before stands in front
                depth = changes([pa.concat_arrays([a, b]) for a, b in zip(last, own, strict=True)])
            numbers = []
            for k in range(len(names)):
                found = counted(depth < first_level + k, depth <= first_level + k, at[k])
                at[k] = int(found[-1])
                numbers.append(found)
            met = depth.copy()
            if last is None:
                met[0] = len(keys)
            leads = np.minimum(np.minimum.accumulate(met), lead)
            lead = int(leads[-1])
            edge = np.zeros(batch.num_rows, dtype=bool)
            edge[0] = last is None
            last = [c.slice(batch.num_rows - 1) for c in own]
            if waiting:
                yield pa.RecordBatch.from_arrays(waiting[0], names=waiting[1])
            columns = [*batch.columns, *map(pa.array, numbers), pa.array(np.arange(row, row + batch.num_rows))]
            row += batch.num_rows
            labels = [*batch.schema.names, *(f"_at{k}" for k in range(len(names))), *PLACE]
            waiting = [[*columns, pa.array(edge), pa.array(leads.astype(np.int32))], labels]
        if waiting:
            edge = waiting[0][-2].to_numpy(zero_copy_only=False).copy()
            edge[-1] = True
            waiting[0][-2] = pa.array(edge)
            yield pa.RecordBatch.from_arrays(waiting[0], names=waiting[1])

    hashable = [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    in_order = df.repartitionByRange(*keys, F.xxhash64(*hashable)).sortWithinPartitions(*keys)
    numbered = in_order.mapInArrow(scan, StructType([*kinds, *added]))
    range_id = F.shiftright(F.monotonically_increasing_id(), ROW_BITS).alias("_range")
    placed = settle(numbered.select("*", range_id), "levels")
    edges = placed.where("_edge").orderBy("_range", "_row").collect()
    offsets = df.sparkSession.createDataFrame(
        carried(edges, keys, first_level, len(names)),
        ", ".join(["_range long", *(f"_plus{k} long" for k in range(len(names)))]),
    )
    joined = placed.join(offsets, "_range")
    return joined.select(
        *df.columns,
        *(
            (F.col(f"_at{k}") + F.when(F.col("_lead") >= first_level + k, F.col(f"_plus{k}")).otherwise(0)).alias(name)
            for k, name in enumerate(levels.values())
        ),
    )


def carried(edges: Sequence[Row], keys: Sequence[str], first_level: int, n: int) -> list[tuple[int, ...]]:
    """What is added in each range to the numbers of the groups that are open where it begins.

    ``edges`` are the first and last row of every range, in order; a range of one row has it once.
    """
    found, before, at = [], None, []
    for k, edge in enumerate(edges):
        own = [edge[c] for c in keys]
        if edge["_row"] == 0:
            plus = [0] * n
            for level in range(n) if before is not None else ():
                upto = first_level + level
                if before[:upto] == own[:upto]:
                    plus[level] = at[level] - (before[upto] == own[upto])
            found.append((edge["_range"], *plus))
        if k + 1 == len(edges) or edges[k + 1]["_row"] == 0:
            before = own
            at = [
                edge[f"_at{level}"] + (found[-1][1 + level] if edge["_lead"] >= first_level + level else 0)
                for level in range(n)
            ]
    return found
