"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of three neighbouring letters is the product of
the first letter's vector rotated twice, the second's rotated once and the third's; what is not a letter counts
as one blank at the edge of a word. The vector of a text is the sum over its letter triples, a language's
prototype the sum over its training texts; the nearest prototype by cosine names the language.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lanehouse.llm.frames import cut, remainder, texts, utf8
from lanehouse.llm.words import mix

DIMENSION = 1024
UNKNOWN = "und"
#: letter triples are numbered without sorting up to so many
DENSE = 1 << 23
#: cells of one table of counts
CELLS = 4 << 20

SCORES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
    ]
)
PARTS = pa.schema([("lang", pa.string()), ("vector", pa.list_(pa.int64()))])


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point its letter in lower case, or 0 where it is no letter."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        character = chr(point)
        if character.isalpha():
            table[point] = ord(character.lower()[0])
    return table


def letter_vectors(points: np.ndarray, dimension: int = DIMENSION) -> np.ndarray:
    """A row of +1 and -1 per code point, the same in every process."""
    words = np.arange(-(-dimension // 64), dtype=np.uint64)
    seeds = mix(points.astype(np.uint64)[:, None] * np.uint64(1_000_003) + words[None, :] + np.uint64(17))
    bits = np.unpackbits(seeds.view(np.uint8), axis=1)[:, :dimension]
    return (bits.astype(np.int8) << 1) - 1


def triples(data: np.ndarray, bounds: np.ndarray):
    """The letters that occur, every triple as three places among them, and its text."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
    found = letters()[points]
    present = np.zeros(0x110000, dtype=bool)
    present[found] = True
    present[0] = True
    alphabet = np.flatnonzero(present)
    place = np.zeros(0x110000, dtype=np.int64)
    place[alphabet] = np.arange(len(alphabet))
    here = place[found]
    before, after = np.roll(here, 1), np.roll(here, -1)
    inner = begins[(begins >= 0) & (begins < len(here))]
    before[inner] = 0
    after[inner - 1] = 0
    if len(here):
        before[0] = after[-1] = 0
    middle = np.flatnonzero(here)
    text = np.searchsorted(begins, middle, side="right") - 1
    return alphabet, (before[middle], here[middle], after[middle]), text


def counted(data: np.ndarray, bounds: np.ndarray, dimension: int = DIMENSION):
    """Vectors of the distinct letter triples, and per occurrence the triple's row and the text."""
    alphabet, (a, b, c), text = triples(data, bounds)
    size = len(alphabet)
    code = (a * size + b) * size + c
    if size**3 <= DENSE:
        seen = np.zeros(size**3, dtype=bool)
        seen[code] = True
        distinct = np.flatnonzero(seen)
        row = np.zeros(size**3, dtype=np.int64)
        row[distinct] = np.arange(len(distinct))
        code = row[code]
    else:
        distinct, code = np.unique(code, return_inverse=True)
    each = letter_vectors(alphabet, dimension)
    vectors = (
        np.roll(each, 2, axis=1)[distinct // size**2]
        * np.roll(each, 1, axis=1)[distinct // size % size]
        * each[distinct % size]
    )
    return vectors, code, text


def text_vectors(data: np.ndarray, bounds: np.ndarray, dimension: int = DIMENSION):
    """Runs of texts with their vectors, one row per text."""
    vectors, code, text = counted(data, bounds, dimension)
    vectors = vectors.astype(np.float32)
    step = max(1, CELLS // max(1, len(vectors)))
    for first in range(0, len(bounds) - 1, step):
        last = min(first + step, len(bounds) - 1)
        low, high = np.searchsorted(text, [first, last])
        cells = (text[low:high] - first) * len(vectors) + code[low:high]
        counts = np.bincount(cells, minlength=(last - first) * len(vectors))
        yield counts.reshape(last - first, len(vectors)).astype(np.float32) @ vectors


def learn(docs: DataFrame, train: Column, dimension: int = DIMENSION) -> dict[str, np.ndarray]:
    """The prototype of every language of the rows where ``train`` holds and ``lang`` is not NULL.

    Each task sums its texts by language; the sums of the tasks are added by Spark, so the driver gets
    one vector per language.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in cut(batches):
            vectors, code, text = counted(*utf8(batch.column("text")), dimension)
            coded = batch.column("lang").dictionary_encode()
            of_text = coded.indices.to_numpy()
            for number, name in enumerate(coded.dictionary.to_pylist()):
                own = code[of_text[text] == number]
                counts = np.bincount(own, minlength=len(vectors)).astype(np.float64)
                total = np.rint(counts @ vectors.astype(np.float64)).astype(np.int64)
                sums[name] = sums.get(name, 0) + total
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums, pa.string()), pa.array(list(sums.values()), PARTS.field(1).type)], schema=PARTS
        )

    wanted = docs.where(train & F.col("lang").isNotNull())
    parts = texts(wanted, F.col("lang").cast("string").alias("lang")).mapInArrow(
        part, from_arrow_schema(PARTS)
    )
    sums = parts.select("lang", F.posexplode("vector")).groupBy("lang", "pos").agg(F.sum("col").alias("n"))
    found: dict[str, np.ndarray] = {}
    for row in sums.toLocalIterator():
        found.setdefault(row.lang, np.zeros(dimension))[row.pos] = row.n
    return {name: found[name] for name in sorted(found)}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], held_out: Column) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score``, the cosine (0 where negative), per row.

    A text without a letter, NULL included, and any text where no language is known gets ``und`` and 0.
    Of equally near languages the first by name is taken.
    """
    names = np.array([*prototypes, UNKNOWN])
    dimension = len(next(iter(prototypes.values()), np.zeros(DIMENSION)))
    table = np.array([v / (np.linalg.norm(v) or 1) for v in prototypes.values()]).reshape(-1, dimension)
    table = table.astype(np.float32)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            best, nearest = [], []
            for vectors in text_vectors(*utf8(batch.column("text")), dimension):
                norms = np.linalg.norm(vectors, axis=1)
                cosines = np.full((len(vectors), len(names)), -2.0)
                cosines[:, :-1] = vectors @ table.T / np.where(norms > 0, norms, 1)[:, None]
                cosines[norms == 0] = -2.0
                cosines[:, -1] = np.where((norms > 0) & (len(names) > 1), -3.0, 0.0)
                nearest.append(cosines.argmax(axis=1))
                best.append(np.clip(cosines.max(axis=1), 0, 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(names[np.concatenate([[], *nearest]).astype(int)], pa.string()),
                    pa.array(np.concatenate([[], *best]), pa.float64()),
                ],
                schema=SCORES,
            )

    return texts(docs, held_out.alias("held_out")).mapInArrow(score, from_arrow_schema(SCORES))


def language_id(docs: DataFrame) -> DataFrame:
    """Learn from three quarters of ``docs`` (by crc32 of the id) and predict all of them, see ``identify``.

    Repeated rows count as often as they occur; a NULL ``doc_id`` hashes as the empty text; other columns
    are ignored; no rows give none.
    """
    held_out = remainder(4) == 2
    return identify(docs, learn(docs, ~held_out), held_out)
