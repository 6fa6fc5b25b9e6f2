"""Token counts: pieces are counted once per distinct pre-token and summed per document.

A pre-token is what the tokenizer's own pattern cuts out of a text; its pieces don't depend on what
stands around it. So a document's count is the sum, over its distinct pre-tokens, of how often each occurs
times how many pieces it has. No token id is kept anywhere.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lanehouse.llm.exchange import ask, bucket_bits, bucket_edges, with_answers
from lanehouse.llm.frames import gathered, keep, packed, texts, unpacked, utf8
from lanehouse.llm.words import span_hashes

CHUNK_BYTES = 4 << 20
BUCKET_WORDS = 150_000
#: texts above this many characters are cut one pre-token at a time
LONG_TEXT = 8 << 20

#: fixed values: the pattern of the tokenizer's pre-tokenizer, and its white space
SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACES + r"\p{L}\p{N}]+"
    r"|[" + SPACES + r"]+(?![^" + SPACES + r"])|[" + SPACES + r"]+"
)

CHUNKS = pa.schema(
    [
        ("chunk", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_bytes", pa.list_(pa.int64())),
        ("specials", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("places", pa.binary()),
        ("counts", pa.binary()),
        ("words", pa.list_(pa.string())),
        ("n_words", pa.int64()),
    ]
)
REQUESTS = pa.schema(
    [("chunk", pa.int64()), ("bucket", pa.int32()), ("words", pa.binary()), ("sizes", pa.binary())]
)
ANSWERS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("pieces", pa.binary())])


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer at ``path``, a pattern that cuts as it does, and its special strings."""
    import regex
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    specials = sorted(t.content for t in tokenizer.get_added_tokens_decoder().values())
    return tokenizer, regex.compile(PATTERN), specials, {}


class Cutter:
    """Cuts texts into pre-tokens as the tokenizer at ``path`` does."""

    def __init__(self, path: str) -> None:
        import regex

        self.tokenizer, self.pattern, self.specials, self.same = load(path)
        self.special = regex.compile("|".join(map(regex.escape, self.specials)) or r"(?!)")

    def agrees(self, character: str) -> bool:
        """Whether the pattern and the tokenizer have ``character`` in the same class."""
        if character not in self.same:
            probe = f"a{character}a 1{character}1 ,{character},  {character} x"
            own = [len(x.encode()) for x in self.pattern.findall(probe)]
            self.same[character] = own == [
                len(x) for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)
            ]
        return self.same[character]

    def pieces(self, text: str):
        if not text.isascii() and not all(map(self.agrees, set(text))):
            return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        if len(text) > LONG_TEXT:
            return (found.group() for found in self.pattern.finditer(text))
        return self.pattern.findall(text)

    def counted(self, text: str) -> tuple[Counter, int]:
        """How often each pre-token occurs, and the number of special strings."""
        if not any(s in text for s in self.specials):
            return Counter(self.pieces(text)), 0
        parts = self.special.split(text)
        counts: Counter = Counter()
        for part in parts:
            counts.update(self.pieces(part))
        return counts, len(parts) - 1


def _encode(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, part = Cutter(path), TaskContext.get().partitionId()
        for number, batch in enumerate(gathered(batches, size=CHUNK_BYTES)):
            local: dict[str, int] = {}
            places, counts, sizes, specials = array("i"), array("i"), [], []
            for value in batch.column("text"):
                found, special = cutter.counted(value.as_py())
                places.extend([local.setdefault(word, len(local)) for word in found])
                counts.extend(found.values())
                sizes.append(len(found))
                specials.append(special)
            words = pa.array(list(local), pa.string())
            data, bounds = utf8(words)
            by_hash = np.argsort(span_hashes(data, bounds[:-1], bounds[1:]), kind="stable")
            rank = np.empty(len(local), dtype=np.int64)
            rank[by_hash] = np.arange(len(local))
            # each document's places in rising order, as steps, which pack well
            place = rank[np.frombuffer(places, dtype=np.int32)]
            counts = np.frombuffer(counts, dtype=np.int32)
            order = np.argsort(np.repeat(np.arange(len(sizes)), sizes) * len(local) + place)
            place = place[order]
            rise = np.diff(place, prepend=0)
            first = np.cumsum([0, *sizes])[:-1]
            first = first[np.array(sizes) > 0]
            rise[first] = place[first]
            row = {
                "chunk": (part << 32) + number,
                "doc_ids": batch.column("doc_id").to_pylist(),
                "n_bytes": np.diff(utf8(batch.column("text"))[1]),
                "specials": specials,
                "sizes": sizes,
                "places": packed(rise),
                "counts": packed(counts[order]),
                "words": words.take(pa.array(by_hash)),
                "n_words": len(local),
            }
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[f.name]], f.type) for f in CHUNKS], schema=CHUNKS
            )

    return encode


def _requests(bits: int):
    def requests(batch: pa.RecordBatch) -> Iterator[tuple]:
        data, bounds = utf8(batch.column("words").flatten())
        edges = bucket_edges(span_hashes(data, bounds[:-1], bounds[1:]), bits)
        chunk = batch.column("chunk")[0].as_py()
        for bucket in np.flatnonzero(np.diff(edges)):
            own = bounds[edges[bucket] : edges[bucket + 1] + 1]
            words = zstandard.compress(data[own[0] : own[-1]].tobytes(), 1)
            yield chunk, int(bucket), words, packed(np.diff(own))

    return requests


def _answers(path: str):
    def answers(table: pa.Table) -> pa.Table:
        sizes = [unpacked(part) for part in table.column("sizes").to_pylist()]
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes), dtype=np.int64)])
        data = b"".join(map(zstandard.decompress, table.column("words").to_pylist()))
        asked = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(data))
        coded = asked.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        tokenizer = load(path)[0]
        pieces = np.fromiter(
            (
                len(encoded)
                for first in range(0, len(distinct), 10_000)
                for encoded in tokenizer.encode_batch_fast(
                    distinct[first : first + 10_000], add_special_tokens=False
                )
            ),
            dtype=np.int32,
            count=len(distinct),
        )
        found = pieces[coded.indices.to_numpy()]
        ends = np.cumsum([len(part) for part in sizes])
        replies = [part.tobytes() for part in np.split(found, ends[:-1])]
        return pa.Table.from_arrays(
            [table.column("chunk"), table.column("bucket"), pa.array(replies, pa.binary())],
            schema=ANSWERS,
        )

    return answers


def _sums(limit: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_bytes", pa.int64()),
            ("n_tokens", pa.int64()),
            ("over_limit", pa.bool_()),
        ]
    )

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pieces = b"".join(answer["pieces"] for answer in row["answers"] or ())
                each = np.frombuffer(pieces, dtype=np.int32).astype(np.int64)
                rise = unpacked(row["places"]).astype(np.int64)
                ends = np.cumsum(np.array(row["sizes"], dtype=np.int64))
                first = np.concatenate([[0], ends[:-1]])
                place = np.concatenate([[0], np.cumsum(rise)])
                place = place[1:] - np.repeat(place[first], row["sizes"])
                total = np.concatenate([[0], np.cumsum(each[place] * unpacked(row["counts"]))])
                tokens = total[ends] - total[first] + np.array(row["specials"], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["n_bytes"], pa.int64()),
                        pa.array(tokens),
                        pa.array(tokens > limit),
                    ],
                    schema=schema,
                )

    return sums, from_arrow_schema(schema)


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit``) per row of ``docs``.

    Counts what the byte-level tokenizer at ``path`` gives for the whole text, without added tokens; its
    special strings inside a text count as one token each. NULL text is empty and has no tokens, a NULL
    ``doc_id`` stays, repeated rows give a row each, other columns are ignored, no rows give none.

    Documents are put into chunks, each written once with its distinct pre-tokens. Chunks ask buckets of
    pre-tokens, which run the tokenizer on each distinct one, and join the answers to their frequencies.
    """
    chunks = keep(
        texts(docs).mapInArrow(_encode(path), from_arrow_schema(CHUNKS)), "pre-tokens"
    )
    asked = chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    bits = bucket_bits(asked, BUCKET_WORDS)
    replies = ask(chunks, _requests(bits), REQUESTS, _answers(path), ANSWERS)
    sums, schema = _sums(limit)
    return (
        with_answers(chunks, replies)
        .select("doc_ids", "n_bytes", "specials", "sizes", "places", "counts", "answers")
        .mapInArrow(sums, schema)
    )
