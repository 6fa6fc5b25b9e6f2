"""Token ids in binary files, in the order of the documents.

Ids are numbered anew by how often they occur, the most frequent one 0. A number takes as many bytes as it
needs, one to four; two bits per number, four numbers to a control byte, tell how many. Control bytes stand
apart from the numbers' bytes, so a reader looks the lengths of four numbers up at once and takes all numbers
of a file with a few array operations.

A folder holds ``ranks.ids``, the ids by their new number, and one file or more per range of documents:

    magic (8 bytes), number of documents, ids and number bytes (3 x u64)
    per document: doc_id (i64), whether it is NULL (u8), ids (u64), where its number bytes begin (u64)
    control bytes, each document beginning with a new one; then the number bytes

All numbers are little-endian. A file is written beside its place and renamed, under a name that depends on
its rows only, so a task that runs twice leaves one file; the list of files is a table of its own.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lanehouse.llm.frames import cut, keep, texts, unpacked, utf8
from lanehouse.llm.periodic_runs import split_words
from lanehouse.session import fresh_path

MAGIC = b"LHIDS\x00\x00\x01"
RANKS = "ranks.ids"
#: ids after which a file ends; a longer document has a file of its own
FILE_IDS = 1 << 22
#: tasks that read files, at most
READ_TASKS = 50_000
SLICE_BYTES = 4 << 20
#: words that aren't plain, pieces, and ids of either that a Python worker keeps from one task to the next
KEPT_WORDS, KEPT_PIECES, KEPT_IDS = 200_000, 600_000, 1 << 22
#: pieces that are given to the tokenizer together, at most
JOINED = 2_000
#: fixed values: what the name of a piece's last id ends with; characters that lower case and composition
#: leave single, less the one of special strings; how words of them, in lower case, are cut
LAST = "</w>"
PLAIN = "^[!-{}~À-ÖØ-öø-ÿ]+$"
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")
PROBE = "Ab's C1d  (éÀß!) a\tb c's'tx don't 12"

TOKENS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
COUNTS = pa.schema([("id", pa.int64()), ("n", pa.int64())])
FILES = pa.schema(
    [
        ("range", pa.int32()),
        ("number", pa.int32()),
        ("file", pa.string()),
        ("n_docs", pa.int64()),
        ("n_ids", pa.int64()),
    ]
)
DOCUMENTS = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
)

#: what a byte of a plain word in lower case belongs to, and what makes a contraction after an apostrophe
LETTER, DIGIT, OTHER = 0, 1, 2
KINDS = np.full(256, OTHER, dtype=np.uint8)
KINDS[ord("0") : ord("9") + 1] = DIGIT
KINDS[ord("a") : ord("z") + 1] = KINDS[128:] = LETTER
ENDS_OF_ONE = np.frombuffer(b"stmd", dtype=np.uint8)
ENDS_OF_TWO = np.frombuffer(b"revell", dtype=">u2").astype(np.uint16)

#: the lengths of four numbers by their control byte, and the bits of a number by its length
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def encoded(numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes, number bytes, and where those of each document begin, with their end last.

    ``numbers`` are those of all documents in a row, ``counts`` how many each has.
    """
    numbers = np.ascontiguousarray(numbers, dtype="<u4")
    lengths = 1 + sum((numbers >= 1 << bits).astype(np.uint8) for bits in (8, 16, 24))
    codes = np.zeros(int((counts + -counts % 4).sum()), dtype=np.uint8)
    codes[real_places(counts)] = lengths - 1
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = numbers.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]]
    ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return control, data, ends[np.concatenate([[0], np.cumsum(counts)])]


def real_places(counts: np.ndarray) -> np.ndarray:
    """Which places of all control bytes stand for a number: those of a document's last byte may not."""
    real = np.ones(int((counts + -counts % 4).sum()), dtype=bool)
    ends = np.cumsum(counts + -counts % 4)
    for back in (1, 2, 3):
        real[(ends - back)[-counts % 4 >= back]] = False
    return real


def decoded(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers given to ``encoded``."""
    lengths = LENGTHS[control].ravel()[real_places(counts)]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    wide = np.concatenate([data, np.zeros(4, dtype=np.uint8)])
    # every four neighbouring bytes as a number
    fours = np.ndarray(len(data) + 1, dtype="<u4", buffer=wide, strides=(1,))
    return fours[starts] & MASKS[lengths]


def file_bytes(doc_ids: list[int | None], counts: np.ndarray, numbers: np.ndarray) -> bytes:
    """A file with these documents, ``numbers`` being those of all in a row."""
    control, data, bounds = encoded(numbers, counts)
    head = np.array([len(doc_ids), len(numbers), len(data)], dtype="<u8")
    return b"".join(
        [
            MAGIC,
            head.tobytes(),
            np.array([i or 0 for i in doc_ids], dtype="<i8").tobytes(),
            np.array([i is None for i in doc_ids], dtype=np.uint8).tobytes(),
            counts.astype("<u8").tobytes(),
            bounds[:-1].astype("<u8").tobytes(),
            control.tobytes(),
            data.tobytes(),
        ]
    )


def read_bytes(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """What ``file_bytes`` was given."""
    if content[:8] != MAGIC:
        raise ValueError("not a file of token ids")
    n_docs, n_ids, n_bytes = np.frombuffer(content, dtype="<u8", count=3, offset=8).astype(int).tolist()
    at = 32
    doc_ids = np.frombuffer(content, dtype="<i8", count=n_docs, offset=at).tolist()
    no_id = np.frombuffer(content, dtype=np.uint8, count=n_docs, offset=at + 8 * n_docs)
    counts = np.frombuffer(content, dtype="<u8", count=n_docs, offset=at + 9 * n_docs).astype(np.int64)
    at += 25 * n_docs
    n_control = int((-(-counts // 4)).sum())
    if len(content) != at + n_control + n_bytes or counts.sum() != n_ids:
        raise ValueError("a file of token ids is cut short")
    control = np.frombuffer(content, dtype=np.uint8, count=n_control, offset=at)
    data = np.frombuffer(content, dtype=np.uint8, count=n_bytes, offset=at + n_control)
    named = [None if none else i for i, none in zip(doc_ids, no_id.tolist(), strict=True)]
    return named, counts, decoded(control, data, counts)


def write_file(path: str, content: bytes) -> None:
    """Write beside ``path`` and rename, so that whoever sees the file sees all of it."""
    files, name = fs.FileSystem.from_uri(path)
    folder, _, own = name.rpartition("/")
    files.create_dir(folder, recursive=True)
    beside = f"{folder}/.{own}-{uuid.uuid4().hex}"
    with files.open_output_stream(beside) as stream:
        stream.write(content)
    files.move(beside, name)


def read_file(path: str) -> bytes:
    files, name = fs.FileSystem.from_uri(path)
    with files.open_input_stream(name) as stream:
        return stream.read()


def id_rows(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The bytes of ``ids`` as rows of as many ids as ``sizes`` says."""
    bounds = 4 * np.append(0, np.cumsum(sizes, dtype=np.int64))
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(ids, dtype="<u4"))]
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), buffers)


def cut_words(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of plain words in lower case, and which of them begin a word, with their number last.

    A piece is a contraction, letters, a digit, or what is neither, as ``PIECES`` has them one by one.
    """
    data, bounds = utf8(words)
    data = np.append(data, np.zeros(3, dtype=np.uint8))
    kinds = KINDS[data]
    first = np.zeros(len(data), dtype=bool)
    first[bounds] = True
    begins = first.copy()
    begins[1:] |= (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)
    # an apostrophe that begins a piece goes with the letters of a contraction
    at = np.flatnonzero(begins & (data == ord("'")))
    at = at[~first[at + 1]]
    one = at[np.isin(data[at + 1], ENDS_OF_ONE)]
    at = at[~first[at + 2]]
    two = at[np.isin(data[at + 1] * np.uint16(256) + data[at + 2], ENDS_OF_TWO)]
    begins[one + 1] = begins[two + 1] = False
    begins[one + 2] = begins[two + 3] = True
    places = np.flatnonzero(begins).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places), pa.py_buffer(data))
    return pieces, np.searchsorted(places, bounds)


class Table:
    """Ids by string, a row each; ``learn`` gives those of new strings in a row, and how many each has."""

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> None:
        self.learn = learn
        self.row: dict[str, int] = {}
        self.ids, self.n_ids = id_rows(np.zeros(0), np.zeros(0)), 0

    def __len__(self) -> int:
        return len(self.ids)

    def full(self, most: int) -> bool:
        return len(self) > most or self.n_ids > KEPT_IDS

    def rows(self, strings: list[str]) -> np.ndarray:
        """The rows of distinct strings; new ones are added."""
        rows = np.fromiter(map(self.row.get, strings, repeat(-1)), dtype=np.int64, count=len(strings))
        places = np.flatnonzero(rows < 0)
        if len(places):
            rows[places] = np.arange(len(self), len(self) + len(places))
            new = [strings[k] for k in places.tolist()]
            ids, sizes = self.learn(new)
            if len(sizes) != len(new):
                raise ValueError("the tokenizer leaves a piece out or cuts it")
            self.ids, self.n_ids = pa.concat_arrays([self.ids, id_rows(ids, sizes)]), self.n_ids + len(ids)
            self.row |= zip(new, rows[places].tolist(), strict=True)
        return rows


class Words:
    """Ids of texts, word by word, for a tokenizer that drops white space and lets nothing reach over it.

    A word of plain characters is cut by the tokenizer's own rule into pieces, which need no more preparation;
    the tokenizer's model meets each piece once. Any other word is given to the tokenizer as it is.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit, Sequence

        self.tokenizer, self.model = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.model.normalizer = None
        self.model.pre_tokenizer = Sequence(
            [CharDelimiterSplit(" "), ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        names = {i: name for name, i in self.tokenizer.get_vocab().items()}
        self.ends = np.array([names.get(i, "").endswith(LAST) for i in range(max(names) + 1)])
        self.words, self.pieces = Table(self.of_others), Table(self.of_pieces)
        pieces = PIECES.findall(PROBE.lower())
        known = self.ends[[ids[-1] for ids in self.whole(pieces)]].all()
        if not known or self.ids(pa.array([PROBE]), 0)[0][:-1].tolist() != self.whole([PROBE])[0]:
            raise ValueError("the tokenizer doesn't take a text word by word")

    def forget(self) -> None:
        """Begin anew where too much is known."""
        if self.words.full(KEPT_WORDS):
            self.words = Table(self.of_others)
        if self.pieces.full(KEPT_PIECES):
            self.pieces = Table(self.of_pieces)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def of_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, of which many make one text; the last id of each is told by its name."""
        found = []
        for first in range(0, len(pieces), JOINED):
            text = " ".join(pieces[first : first + JOINED])
            ids = self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids
            found.append(np.array(ids, dtype=np.uint32))
        ids = np.concatenate(found)
        return ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)

    def of_others(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that aren't plain."""
        lists = self.whole(words)
        ids = np.array([i for found in lists for i in found], dtype=np.uint32)
        return ids, np.array([len(found) for found in lists])

    def of_plain(self, words: pa.Array) -> pa.Array:
        """The ids of plain words, a row each."""
        pieces, bounds = cut_words(pc.utf8_lower(words))
        coded = pieces.dictionary_encode()
        rows = self.pieces.rows(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, ends = utf8(self.pieces.ids.take(pa.array(rows[coded.indices.to_numpy()])))
        return id_rows(ids.view("<u4"), np.diff(ends[bounds]) // 4)

    def ids(self, array: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each ended by ``end_id``, and how many each has."""
        self.forget()
        words, bounds = split_words(array)
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        plain = pc.match_substring_regex(distinct, PLAIN)
        others = distinct.filter(pc.invert(plain)).to_numpy(zero_copy_only=False)
        other_rows = self.words.rows(others.tolist())
        end = id_rows(np.array([end_id]), np.ones(1))
        rows = [self.of_plain(distinct.filter(plain)), self.words.ids.take(pa.array(other_rows)), end]
        # plain words come first among the rows, the end of a text is the last one
        place = np.empty(len(distinct), dtype=np.int64)
        place[np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(distinct))
        row = np.insert(place[coded.indices.to_numpy()], bounds[1:], len(distinct))
        ids, ends = utf8(pa.concat_arrays(rows).take(pa.array(row)))
        upto = bounds + np.arange(len(bounds))
        return ids.view("<u4"), np.diff(ends[upto]) // 4


def packed_parts(ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """What ``packed`` makes of the ids between every two neighbouring bounds, split into bytes at once."""
    planes = np.stack([(ids >> bits).astype(np.uint8) for bits in (0, 8, 16, 24)])
    compress = zstandard.ZstdCompressor(level=1).compress
    return [compress(planes[:, a:b].ravel()) for a, b in pairwise(bounds.tolist())]


@lru_cache(maxsize=1)
def words_of(path: str) -> Words:
    return Words(path)


def token_rows(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the packed ``ids`` of every text, ``end_id`` last."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(tokenizer_path)
        for batch in cut(batches, size=SLICE_BYTES):
            ids, counts = words.ids(batch.column("text"), end_id)
            parts = packed_parts(ids, np.append(0, np.cumsum(counts)))
            columns = [batch.column("doc_id"), pa.array(counts), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=TOKENS)

    return texts(docs).mapInArrow(encode, from_arrow_schema(TOKENS))


def id_counts(tokens: DataFrame) -> DataFrame:
    """How often each id occurs; a task hands on one row per id it has met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for part in cut([batch], "ids"):
                own = np.bincount(np.concatenate([unpacked(x) for x in part.column("ids").to_pylist()]))
                if len(own) > len(counts):
                    counts, own = own, counts
                counts[: len(own)] += own
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], schema=COUNTS)

    counted = tokens.select("ids").mapInArrow(count, from_arrow_schema(COUNTS))
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(
    docs: DataFrame, tokenizer_path: str, folder: str, end_id: int, file_ids: int = FILE_IDS
) -> DataFrame:
    """Write the ids of all documents below ``folder``; the table of files, with the ids before each.

    Documents stand in ascending ``doc_id``, NULL first, repeated rows side by side; NULL text is empty and
    has the end id alone; other columns are ignored; no documents give no files. The ids are found once and
    written; their counts, one per id of the vocabulary, are all that comes to the driver.
    """
    tokens = keep(
        token_rows(docs, tokenizer_path, end_id).withColumn("uid", F.monotonically_increasing_id()), "tokens"
    )
    ranked = id_counts(tokens).orderBy(F.desc("n"), "id").select("id").toArrow()
    by_number = ranked.column("id").to_numpy().astype("<u4")
    write_file(f"{folder}/{RANKS}", MAGIC + by_number.tobytes())
    numbers = np.zeros(int(by_number.max(initial=0)) + 1, dtype=np.uint32)
    numbers[by_number] = np.arange(len(by_number))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        doc_ids: list[int | None] = []
        held: list[np.ndarray] = []
        size = number = 0

        def close() -> pa.RecordBatch:
            path = f"{folder}/part-{part:06d}-{number:06d}.ids"
            counts = np.array([len(x) for x in held], dtype=np.int64)
            write_file(path, file_bytes(doc_ids, counts, np.concatenate(held)))
            row = ([part], [number], [path], [len(held)], [size])
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(row, FILES, strict=True)], schema=FILES
            )

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                doc_ids.append(doc_id)
                held.append(numbers[unpacked(ids.as_py())])
                size += len(held[-1])
                if size >= file_ids:
                    yield close()
                    doc_ids, held, size, number = [], [], 0, number + 1
        if held:
            yield close()

    in_order = tokens.repartitionByRange("doc_id", "uid").sortWithinPartitions("doc_id", "uid")
    written = keep(in_order.select("doc_id", "ids").mapInArrow(write, from_arrow_schema(FILES)), "files")
    before = F.sum("n_ids").over(
        Window.orderBy("range", "number").rowsBetween(Window.unboundedPreceding, -1)
    )
    return written.withColumn("start", F.coalesce(before, F.lit(0).cast("long")))


def read_ids(files: DataFrame, folder: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids`` of all documents, from the files that ``files`` lists.

    ``ids`` are little-endian unsigned 32-bit numbers, as bytes. Every file is read by one task.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_number = None
        for batch in batches:
            for path, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if by_number is None:
                    by_number = np.frombuffer(read_file(f"{folder}/{RANKS}"), dtype="<u4", offset=8)
                doc_ids, counts, numbers = read_bytes(read_file(path))
                ids, bounds = by_number[numbers], np.concatenate([[0], np.cumsum(counts)])
                for first in range(0, len(doc_ids), 1000):
                    own = slice(first, first + 1000)
                    parts = [
                        ids[a:b].tobytes() for a, b in zip(bounds[own], bounds[1:][own], strict=False)
                    ]
                    columns = (doc_ids[own], before + bounds[:-1][own], counts[own], parts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, DOCUMENTS, strict=True)],
                        schema=DOCUMENTS,
                    )

    tasks = min(max(files.count(), 1), READ_TASKS)
    spread = files.select("file", "start").repartition(tasks, "file")
    return spread.mapInArrow(read, from_arrow_schema(DOCUMENTS))


def id_folder(spark: SparkSession) -> str:
    """A new folder for id files in the shared work folder."""
    return fresh_path(spark, "ids")
