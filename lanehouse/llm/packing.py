"""Packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lanehouse.llm.frames import cut, keep, texts

#: pieces that are packed together in one task
GROUP_PIECES = 20_000

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)
PLACES = pa.schema([("uid", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


@lru_cache(maxsize=4)
def byte_encoder(ranks_path: str):
    """The byte-level tokenizer whose ranks are at ``ranks_path``; its special string has the next free id."""
    import base64

    import tiktoken
    from public_tokenizers import PATTERN

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)}
    )


@lru_cache(maxsize=4)
def whole_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_ids(text: str, tokenizer_path: str, ranks_path: str | None = None) -> np.ndarray:
    """The ids that the tokenizer at ``tokenizer_path`` gives; a special string inside the text gives its id.

    ``ranks_path`` is the same vocabulary for a library that gives the same ids faster. It takes no very long
    stretch of white space; a text with one goes to the tokenizer itself.
    """
    if ranks_path is not None:
        try:
            return byte_encoder(ranks_path).encode_to_numpy(text, allowed_special="all")
        except ValueError:
            pass
    found = whole_tokenizer(tokenizer_path).encode(text, add_special_tokens=False)
    return np.array(found.ids, dtype=np.uint32)


def piece_starts(tokens: int, size: int) -> list[int]:
    """Where the pieces of a document begin: all but the first are full."""
    first = tokens % size or size
    return [0, *range(first, tokens, size)]


def pieces(
    docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0, ranks_path: str | None = None
) -> DataFrame:
    """A row per piece: ``doc_id``, ``piece`` (from 0), ``start``, ``length``, ``ids_crc32``.

    A document is the ids of its text, see ``token_ids``, and then ``end_id``. One of more than ``size`` tokens is cut into
    pieces of ``size``, of which the first may be shorter. The checksum is over little-endian 32-bit ids.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.append(token_ids(text, tokenizer_path, ranks_path), end_id).astype("<u4")
                starts = piece_starts(len(ids), size)
                for number, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    row = (doc_id, number, start, end - start, zlib.crc32(ids[start:end].tobytes()))
                    for column, value in zip(rows, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(rows, PIECES, strict=True)], schema=PIECES
            )

    return texts(docs).mapInArrow(encode, from_arrow_schema(PIECES))


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset for each of ``lengths``, which come in this order.

    Each goes to the open sequence that makes the sum, over all gaps, of the squared number of open
    sequences with that gap smallest; of equals, to the one with the smallest gap. A sequence is opened
    only where none has room.
    """
    # open sequences by gap; a full one is not open
    gaps = np.zeros(size + 1, dtype=np.int64)
    waiting: list[list[int]] = [[] for _ in range(size + 1)]
    number = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    opened = 0
    for k, length in enumerate(lengths.tolist()):
        before = gaps[length:]
        # the change of the sum, without what is equal for all
        change = np.where(before > 0, 2 * (gaps[: size + 1 - length] - before), 4 * len(lengths))
        change[0] -= 1
        best = int(change.argmin())
        if before[best]:
            gap = best + length
            place = waiting[gap].pop()
            gaps[gap] -= 1
        else:
            gap, place = size, opened
            opened += 1
        number[k], offset[k] = place, size - gap
        if gap > length:
            waiting[gap - length].append(place)
            gaps[gap - length] += 1
    return number, offset


def best_fit(pieces: DataFrame, size: int = 2048, group: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: sequences of at most ``size`` tokens without gaps.

    Full pieces are sequences of their own. The others are dealt by a hash into groups of about ``group``
    and packed in falling length, each group by itself, so that tasks don't grow with the table; a group
    leaves a sequence or two partly filled.
    """
    placed = keep(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    short = F.col("length") < size
    groups = -(-placed.where(short).count() // group) or 1

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("uid", "ascending")])
        number, offset = sum_of_squares(table.column("length").to_numpy(), size)
        number = (table.column("part").to_numpy().astype(np.int64) << 32) + number
        return pa.Table.from_arrays(
            [table.column("uid"), pa.array(number * 2), pa.array(offset)], schema=PLACES
        )

    dealt = placed.where(short).select(
        F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int").alias("part"), "uid", "length"
    )
    packed = dealt.groupBy("part").applyInArrow(pack, from_arrow_schema(PLACES))
    joined = placed.where(short).join(packed, "uid")
    full = placed.where(~short).select(
        *placed.columns, (F.col("uid") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return joined.select(*full.columns).unionByName(full).drop("uid")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0, ranks_path: str | None = None
) -> DataFrame:
    """The pieces of all documents with their places, see ``pieces`` and ``best_fit``.

    NULL text is empty: the end id alone. A NULL ``doc_id`` stays, repeated rows are packed each for
    itself, other columns are ignored, no rows give none.
    """
    return best_fit(pieces(docs, tokenizer_path, size, end_id, ranks_path), size)
