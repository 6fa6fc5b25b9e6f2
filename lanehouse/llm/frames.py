"""What the operators share: the wanted columns of a table, written tables, and slices of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanehouse.session import fresh_path

SLICE_BYTES = 1 << 20


def free(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as it takes to be none of the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as long, ``text`` with NULL as the empty text, and the columns ``more``; all else goes."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def remainder(modulus: int) -> Column:
    """crc32 of ``doc_id`` as text, modulo ``modulus``; a NULL ``doc_id`` counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared work folder, compressed well, and read it back."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``size`` bytes of ``column``, one row at least."""
    for batch in batches:
        ends = offsets(batch.column(column))
        first = 0
        while first < batch.num_rows:
            after = int(ends.searchsorted(ends[first] + size, side="right")) - 1
            after = min(max(after, first + 1), batch.num_rows)
            yield batch.slice(first, after - first)
            first = after


def gathered(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches joined, or cut, to about ``size`` bytes of ``column``."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for piece in cut(batches, column, size):
        ends = offsets(piece.column(column))
        waiting.append(piece)
        held += int(ends[-1] - ends[0])
        if held >= size:
            yield pa.concat_batches(waiting)
            waiting, held = [], 0
    if waiting:
        yield pa.concat_batches(waiting)


def offsets(array: pa.Array):
    """Byte offsets of the strings of ``array`` in its data, one more than there are strings."""
    import numpy as np

    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    kind = np.int64 if wide else np.int32
    if array.buffers()[1] is None:
        return np.zeros(len(array) + 1, dtype=np.int64)
    found = np.frombuffer(array.buffers()[1], dtype=kind)
    return found[array.offset : array.offset + len(array) + 1].astype(np.int64)


def utf8(array: pa.Array):
    """The bytes of all strings of ``array`` in a row, and where each begins, with the end last."""
    import numpy as np

    bounds = offsets(array)
    data = array.buffers()[2]
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, dtype=np.uint8), bounds - bounds[0]
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def packed(values, kind: str = "<u4") -> bytes:
    """Numbers of ``kind`` as compressed bytes: first all lowest bytes, then the next ones."""
    import numpy as np
    import zstandard

    size = np.dtype(kind).itemsize
    planes = np.ascontiguousarray(values, dtype=kind).view(np.uint8).reshape(-1, size).T
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(data: bytes, kind: str = "<u4"):
    """The values given to ``packed``."""
    import numpy as np
    import zstandard

    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
