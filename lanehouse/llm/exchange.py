"""Counts for the keys of chunks: every chunk asks each bucket of keys once and gets one answer.

A chunk holds some documents in encoded form and its distinct keys, sorted by hash. Buckets are ranges of
the hash, so the answers of a chunk, put together in the order of the buckets, stand in the order of its keys.
A key is sent once per chunk, however often it occurs: the bucket of a word that all chunks have gets one
entry per chunk for it. The messages of a chunk are as many as the buckets, which grow with the table, up to one
for each of its distinct keys; beyond that they grow as the rows of a plain join on the keys would.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

#: keys that one bucket gets in all
BUCKET_KEYS = 1_000_000

def bucket_bits(keys: int, per_bucket: int = BUCKET_KEYS) -> int:
    """Leading bits of the hash that name the bucket: as many buckets as ``keys`` need."""
    return max(2, (max(keys, 1) // per_bucket).bit_length())


def bucket_edges(hashes, bits: int):
    """Where each bucket begins in the sorted 64-bit ``hashes``, with their number last."""
    import numpy as np

    starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(hashes, starts), len(hashes))


def ask(
    chunks: DataFrame,
    requests: Callable[[pa.RecordBatch], Iterator[tuple]],
    asked: pa.Schema,
    answers: Callable[[pa.Table], pa.Table],
    answered: pa.Schema,
) -> DataFrame:
    """The answers of all buckets, rows of ``answered``.

    ``requests`` turns a batch of one chunk into rows of ``asked``, and ``answers`` all requests to one
    bucket into rows of ``answered``. Both schemas begin with ``chunk`` (long) and ``bucket`` (int).
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = list(requests(batch.slice(row, 1)))
                if found:
                    columns = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, asked, strict=True)], schema=asked
                    )

    sent = chunks.mapInArrow(send, from_arrow_schema(asked))
    return sent.groupBy("bucket").applyInArrow(answers, from_arrow_schema(answered))


def with_answers(chunks: DataFrame, replies: DataFrame) -> DataFrame:
    """``chunks`` with ``answers``: an array of what its buckets answered, in their order."""
    parts = F.struct("bucket", *(c for c in replies.columns if c not in ("chunk", "bucket")))
    together = replies.groupBy("chunk").agg(F.array_sort(F.collect_list(parts)).alias("answers"))
    return chunks.join(together, "chunk", "left")
