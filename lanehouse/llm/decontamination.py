"""Documents that contain benchmark items, word for word or paraphrased.

Items are cut into overlapping passages of a few words, weighted by tf-idf with the document frequencies of
the whole corpus. A randomised singular value decomposition of the passages gives a latent space; windows of
the documents are folded into it and compared with the passages by cosine. What is near is checked on the
words: how much of the item is a common subsequence of the place in the document, and whether the item's
answer, its last sentence, is there too.

Whole items are also searched word for word, which finds them wherever they stand; short items only so.
Every window with a word of the benchmark is folded in: words that no item has don't count in its length, so
their weight says nothing about its cosine. Neighbouring windows share half of their words, which are summed once.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lanehouse.llm.frames import cut, keep, texts, utf8
from lanehouse.llm.svd import dense, right_vectors
from lanehouse.llm.words import LOWER, SPACE, mix, span_hashes, word_spans

#: words of a passage by the least number of words of its items; the step is half of it. Items that must stand
#: without a gap need none
WINDOWS = {12: 16, 8: 4, 2: 0}
RANK = 128
#: share of a window's weight on words of the benchmark, which any such word reaches, and cosine to a passage
LEAST_SHARE, LEAST_COSINE = 1e-9, 0.65
#: an item is there if so much of its words is, or if so much is and so much of its answer
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.5, 0.6
#: items of fewer words must be there without a gap
SHORT_ITEM = 8
#: items are searched in blocks of about so many bytes of text, each in one scan of the documents
BLOCK_BYTES = 2 << 20
#: windows that are folded in at a time
FOLDED = 4096
#: words of an item that fit into one number, and numbers an item has for all words
BITS, BUCKETS = 64, 512

#: words are separated by whatever is not a letter or digit; these are the ASCII ones
BETWEEN = SPACE.copy()
BETWEEN[[b for b in range(128) if not chr(b).isalnum()]] = True
#: code points of scripts that put no spaces between words (Thai, Lao, Myanmar, Khmer, Tai, Kana, Bopomofo, Yi, Han);
#: each of their characters is a word
UNSPACED = [
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x3005, 0x3007),
    (0x3040, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA48F), (0xA9E0, 0xA9FF),
    (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF),
]
SEPARATOR, LETTER, ALONE = 0, 1, 2

LEAKS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("word", pa.int64()),
        ("cosine", pa.float64()),
        ("common", pa.float64()),
        ("answered", pa.float64()),
    ]
)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Of every code point, whether it separates words, belongs to one (marks and joiners too), or is one."""
    table = np.full(0x110000, SEPARATOR, dtype=np.uint8)
    for code in range(0x40000):
        if (c := chr(code)).isalnum() or unicodedata.category(c)[0] == "M" or code in (0x200C, 0x200D):
            table[code] = LETTER
    for first, last in UNSPACED:
        own = table[first : last + 1]
        own[own == LETTER] = ALONE
    return table


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, number of bytes, and class of every character beyond ASCII."""
    lead = np.flatnonzero(data >= 0xC0)
    size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
    code = (data[lead] & (0x7F >> size)).astype(np.int64)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        # the last bytes may be cut off where a text isn't valid UTF-8
        code[more] = code[more] << 6 | data[np.minimum(lead[more] + k, len(data) - 1)] & 0x3F
    return lead, size, classes()[np.minimum(code, 0x10FFFF)]


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word; ASCII letters in lower case."""
    low = LOWER[data]
    if not (low >= 0xC0).any():
        starts, ends, text = word_spans(low, bounds, BETWEEN)
        return span_hashes(low, starts, ends), text
    lead, size, kind = characters(low)
    inside = ~BETWEEN[low]
    for k in range(4):
        own = (kind == SEPARATOR) & (size > k)
        inside[np.minimum(lead[own] + k, len(low) - 1)] = False
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    alone = kind == ALONE
    edges = np.concatenate([bounds, lead[alone], (lead + size)[alone]])
    edges = edges[(edges >= 0) & (edges < len(low))]
    begins[edges] = inside[edges]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | begins[1:]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return span_hashes(low, starts, ends), np.searchsorted(bounds, starts, side="right") - 1


def words_of_text(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return words(data, np.array([0, len(data)]))[0]


def windows(count: np.ndarray, size: int):
    """Texts of ``count`` words each, in a row: start, end and text of their windows of ``size`` words.

    A window starts every ``size`` / 2 words while it adds words to the one before.
    """
    stride = size // 2
    number = np.where(count > 0, 1 + np.maximum(0, -(-(count - size) // stride)), 0)
    text = np.repeat(np.arange(len(count)), number)
    first = np.cumsum(count) - count
    step = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    start = first[text] + step * stride
    return start, np.minimum(start + size, (first + count)[text]), text


def answer_of(text: str) -> str:
    """The last sentence or line with a word in it."""
    parts = [p for p in re.split(r"\n|(?<=[.!?]) |(?<=[。！？])", text) if len(words_of_text(p))]
    return parts[-1] if parts else ""


def common_subsequence(item: list[int], place: list[int]) -> int:
    """The length of the longest common subsequence, a row of the table at a time as the bits of a number."""
    masks: dict[int, int] = {}
    for bit, word in enumerate(item):
        masks[word] = masks.get(word, 0) | 1 << bit
    full = (1 << len(item)) - 1
    row = full
    for word in place:
        hit = row & masks.get(word, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


@dataclass
class Items:
    """A block of the benchmark, in the form in which documents are searched for it."""

    window: int
    ids: list
    words: list[list[int]]
    sets: list[frozenset[int]]
    answers: list[list[int]]
    #: rising hashes of all words, their weights, and the weight of any other word
    vocabulary: np.ndarray
    weights: np.ndarray
    other: float
    #: latent vectors of the words, times their weights, and of the passages with their items
    latent: np.ndarray
    passages: np.ndarray
    passage_item: np.ndarray

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.array([len(own) for own in self.words], dtype=np.int64)

    @cached_property
    def heads(self) -> dict[int, tuple[np.ndarray, list[list[int]]]]:
        """By number of words: rising hashes of the items' first words, SHORT_ITEM at most, and the items of each."""
        result = {}
        for size in sorted({min(len(own), SHORT_ITEM) for own in self.words if own}):
            of: dict[int, list[int]] = {}
            for k, own in enumerate(self.words):
                if min(len(own), SHORT_ITEM) == size:
                    of.setdefault(int(grams(np.array(own[:size], dtype=np.uint64), size)[0]), []).append(k)
            keys = sorted(of)
            result[size] = np.array(keys, dtype=np.uint64), [of[k] for k in keys]
        return result

    @cached_property
    def masks(self) -> np.ndarray:
        """Per item and bucket of words, which of the item's first words are in the bucket; unknown words are last."""
        table = np.zeros((len(self.words), BUCKETS + 1), dtype=np.uint64)
        for row, own in zip(table, self.words, strict=True):
            place = look_up(self.vocabulary, np.array(own[:BITS], dtype=np.uint64))
            np.bitwise_or.at(row, place % BUCKETS, np.uint64(1) << np.arange(len(place), dtype=np.uint64))
        return table


def look_up(vocabulary: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The place of each word in the vocabulary, -1 for others."""
    place = np.searchsorted(vocabulary, word)
    place[place == len(vocabulary)] = 0
    return np.where(vocabulary[place] == word, place, -1)


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many rows of ``docs`` each word of the vocabulary occurs, and the number of rows."""
    schema = pa.schema([("place", pa.int64()), ("n", pa.int64())])
    size = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last place counts the rows
        total = np.zeros(size + 1, dtype=np.int64)
        for batch in cut(batches):
            word, text = words(*utf8(batch.column("text")))
            place = look_up(vocabulary, word)
            known = place >= 0
            found = np.zeros((batch.num_rows, size), dtype=bool)
            found[text[known], place[known]] = True
            total[:size] += found.sum(axis=0)
            total[size] += batch.num_rows
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], schema=schema)

    sums = texts(docs).select("text").mapInArrow(count, from_arrow_schema(schema))
    total = np.zeros(size + 1, dtype=np.int64)
    for row in sums.groupBy("place").agg(F.sum("n").alias("n")).toLocalIterator():
        total[row.place] = row.n
    return total[:size], int(total[size])


def passages_of(items: DataFrame, vocabulary: np.ndarray, weights: np.ndarray, window: int) -> DataFrame:
    """The tf-idf row of every passage: ``item`` (its number), ``columns`` and ``weights``, of length 1."""
    schema = pa.schema(
        [("item", pa.int64()), ("columns", pa.list_(pa.int64())), ("weights", pa.list_(pa.float64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            word, text = words(*utf8(batch.column("text")))
            place = look_up(vocabulary, word)
            rows: tuple[list, list, list] = ([], [], [])
            number = batch.column("item").to_numpy()
            count = np.bincount(text, minlength=batch.num_rows)
            for start, end, k in zip(*windows(count, window), strict=True):
                column, times = np.unique(place[start:end], return_counts=True)
                weight = times * weights[column]
                for values, value in zip(
                    rows, (number[k], column, weight / (np.linalg.norm(weight) or 1)), strict=True
                ):
                    values.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema
            )

    return items.mapInArrow(run, from_arrow_schema(schema))


def prepare(docs: DataFrame, block: DataFrame, window: int, rank: int = RANK) -> Items:
    """Decompose the passages of a block of items (``item_id``, ``text``), weighted by the corpus ``docs``."""
    rows = sorted(map(tuple, block.collect()), key=lambda r: (r[0] is None, r))
    found = [(i, words_of_text(t).tolist(), words_of_text(answer_of(t)).tolist()) for i, t in rows]
    every = [w for _, own, _ in found for w in own]
    vocabulary = np.unique(np.array(every, dtype=np.uint64))
    if not window:
        none = np.zeros((0, 1), dtype=np.float32)
        own = [own for _, own, _ in found]
        return Items(0, [i for i, _, _ in found], own, [], [], vocabulary, none, 0.0, none, none, none)
    seen, n = document_frequencies(docs, vocabulary)
    weights = np.log((n + 1) / (seen + 0.5)).clip(min=0.01)
    spark = docs.sparkSession
    numbered = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "item long, text string")
    passages = keep(passages_of(numbered, vocabulary, weights, window), "passages")
    _, vectors = right_vectors(passages, len(vocabulary), rank)
    schema = pa.schema([("item", pa.int64()), ("latent", pa.list_(pa.float64()))])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            latent = dense(batch, vectors)[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), pa.array(list(latent), schema.field(1).type)], schema=schema
            )

    folded = passages.mapInArrow(fold, from_arrow_schema(schema)).toPandas()
    latent = np.array(folded["latent"].tolist(), dtype=np.float32).reshape(-1, vectors.shape[1])
    norms = np.linalg.norm(latent, axis=1, keepdims=True)
    return Items(
        window=window,
        ids=[i for i, _, _ in found],
        words=[own for _, own, _ in found],
        sets=[frozenset(own) for _, own, _ in found],
        answers=[answer for _, _, answer in found],
        vocabulary=vocabulary,
        weights=weights,
        other=float(np.median(weights)),
        latent=(vectors * weights[:, None]).astype(np.float32),
        passages=latent / np.where(norms > 0, norms, 1),
        passage_item=folded["item"].to_numpy(dtype=np.int64),
    )


def near_windows(items: Items, word: np.ndarray, count: np.ndarray):
    """Arrays of the windows near a passage: start, end and text of the window, number of the item, and cosine."""
    place = look_up(items.vocabulary, word)
    known = place >= 0
    weight = np.where(known, items.weights[place], items.other)
    inside = np.concatenate([[0], np.cumsum(np.where(known, weight**2, 0))])
    whole = np.concatenate([[0], np.cumsum(weight**2)])
    start, end, text = windows(count, items.window)
    share = (inside[end] - inside[start]) / np.maximum(whole[end] - whole[start], 1e-9)
    chosen = np.flatnonzero(share >= LEAST_SHARE)
    stride = items.window // 2
    passages = np.ascontiguousarray(items.passages.T)
    # one more row for words that no item has
    rows = np.concatenate([items.latent, np.zeros((1, items.latent.shape[1]), dtype=np.float32)])
    place = np.append(np.where(known, place, len(items.latent)), len(items.latent))
    for first in range(0, len(chosen), FOLDED):
        own = chosen[first : first + FOLDED]
        # a window is its first half and the next; both are halves of other windows, too
        two = start[own] + stride < end[own]
        halves, first_half = np.unique(np.concatenate([start[own], start[own][two] + stride]), return_index=True)
        ends = np.concatenate([np.minimum(end[own], start[own] + stride), end[own][two]])[first_half]
        sums = np.zeros((len(halves), rows.shape[1]), dtype=np.float32)
        for k in range(stride):
            sums += rows[place[np.where(halves + k < ends, halves + k, len(word))]]
        latent = sums[np.searchsorted(halves, start[own])]
        latent[two] += sums[np.searchsorted(halves, start[own][two] + stride)]
        norms = np.linalg.norm(latent, axis=1)
        near = latent @ passages
        row, passage = np.divmod(
            np.flatnonzero(near >= LEAST_COSINE * np.maximum(norms, 1e-9)[:, None]), len(items.passages)
        )
        if not len(row):
            continue
        item = items.passage_item[passage]
        cosine = near[row, passage] / norms[row]
        # the nearest passage of each item
        order = np.lexsort((-cosine, item, row))
        row, item, cosine = row[order], item[order], cosine[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
        w = own[row[new]]
        yield start[w], end[w], text[w], item[new], cosine[new]


def candidates(items: Items, word: np.ndarray, count: np.ndarray):
    """The windows near a passage one by one."""
    for arrays in near_windows(items, word, count):
        yield from zip(*(a.tolist() for a in arrays), strict=True)


def most_common(items: Items, bucket: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray) -> np.ndarray:
    """No common subsequence of an item and the words from ``low`` to ``high`` is longer than this.

    It is that of the item's first words with words taken for equal if their buckets are, all places at once.
    """
    length = items.lengths[item]
    # of longer items so little fits into a number that the bound says nothing
    size = np.where(length < BITS / PARAPHRASE, high - low, 0)
    order = np.argsort(-size, kind="stable")
    first, own, size = low[order], item[order], size[order]
    full = np.full(len(own), ~np.uint64(0))
    short = length[order] < BITS
    full[short] = (np.uint64(1) << length[order][short].astype(np.uint64)) - np.uint64(1)
    row = full.copy()
    for step in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -step, side="left"))
        old = row[:n]
        hit = old & items.masks[own[:n], bucket[first[:n] + step]]
        row[:n] = ((old + hit) | (old - hit)) & full[:n]
    bound = np.empty(len(own), dtype=np.int64)
    bound[order] = length[order] - np.bitwise_count(row)
    return np.where(length < BITS / PARAPHRASE, bound, length)


def grams(word: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` words in a row."""
    number = max(0, len(word) - size + 1)
    result = np.zeros(number, dtype=np.uint64)
    for k in range(size):
        result = mix(result + word[k : k + number])
    return result


def verbatim(items: Items, word: np.ndarray, owner: np.ndarray):
    """Where whole items stand without a gap, in rising order: first word, its text, and number of the item."""
    found: list[tuple[int, int, int]] = []
    for size, (heads, of_head) in items.heads.items():
        hashes = grams(word, size)
        place = look_up(heads, hashes)
        for at in np.flatnonzero(place >= 0).tolist():
            for item in of_head[place[at]]:
                own = items.words[item]
                last = at + len(own) - 1
                if last < len(word) and owner[last] == owner[at] and word[at : last + 1].tolist() == own:
                    found.append((at, int(owner[at]), item))
    return sorted(found)


def possible(items: Items, word: np.ndarray, count: np.ndarray):
    """The windows near a passage, one by one, without those around which too little of the item can be."""
    first = np.cumsum(count) - count
    place = look_up(items.vocabulary, word)
    bucket = np.where(place >= 0, place % BUCKETS, BUCKETS)
    for start, end, text, item, cosine in near_windows(items, word, count):
        length = items.lengths[item]
        low, high = np.maximum(start - length, first[text]), np.minimum(end + length, (first + count)[text])
        kept = most_common(items, bucket, low, high, item) >= PARAPHRASE * length
        yield from zip(*(a[kept].tolist() for a in (start, end, text, item, cosine)), strict=True)


def leaks(items: Items, data: np.ndarray, bounds: np.ndarray):
    """Text, item, first word of the window, cosine, and shares of the item and of its answer that are there."""
    word, owner = words(data, bounds)
    count = np.bincount(owner, minlength=len(bounds) - 1)
    first = np.cumsum(count) - count
    best: dict[tuple[int, int], tuple] = {}
    whole = set()
    for at, text, item in verbatim(items, word, owner):
        if (text, item) not in whole:
            whole.add((text, item))
            best[text, item] = (at - int(first[text]), 1.0, 1.0, 1.0)
    done: dict[tuple[int, int], int] = {}
    for start, end, text, item, cosine in possible(items, word, count) if items.window else ():
        key, own, answer = (text, item), items.words[item], items.answers[item]
        # the checked place reaches so far that the next windows of the same leak lie within it
        if key in whole or start < done.get(key, -1):
            continue
        low = max(start - len(own), int(first[text]))
        high = min(end + len(own), int(first[text] + count[text]))
        place = word[low:high].tolist()
        # no subsequence is longer than the number of words that the place has of the item
        if sum(map(items.sets[item].__contains__, place)) < PARAPHRASE * len(own):
            continue
        common = common_subsequence(own, place) / len(own)
        answered = common_subsequence(answer, place) / max(len(answer), 1)
        if common >= VERBATIM or (common >= PARAPHRASE and answered >= ANSWER):
            done[key] = end
            if key not in best or (common, cosine) > best[key][1:3]:
                best[key] = (start - int(first[text]), common, cosine, answered)
    for (text, item), (start, common, cosine, answered) in sorted(best.items()):
        yield text, item, start, cosine, common, answered


def blocks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> Iterator[Items]:
    """The benchmark in prepared blocks of items of similar length; items of one word are in none."""
    schema = pa.schema([("item_id", pa.int64()), ("text", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            text = words(*utf8(batch.column("text")))[1]
            n = pa.array(np.bincount(text, minlength=batch.num_rows), pa.int64())
            columns = [batch.column("item_id"), batch.column("text").cast(pa.string()), n]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    every = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        .where(F.col("text").isNotNull())
        .mapInArrow(count, from_arrow_schema(schema))
    )
    above = np.inf
    for least, window in WINDOWS.items():
        own = every.where((F.col("n") >= least) & (F.col("n") < F.lit(above))).select("item_id", "text")
        above = least
        size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        number = -(-size // BLOCK_BYTES)
        for k in range(number):
            block = own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == k)
            if not block.isEmpty():
                yield prepare(docs, block, window, rank)


def find_leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """A row per document and item that it contains, with ``doc_id`` and ``item_id``.

    ``word`` is the number of the first word of the best place, ``cosine`` its window's to the nearest passage
    (1 where the whole item stands without a gap, which is searched for by itself),
    ``common`` the share of the item's words that are there in order, ``answered`` that of its answer's. NULL
    and empty texts contain nothing, and items of one word are not searched; NULL ids stay; repeated documents and
    items give a row each; other columns are ignored; without documents or items there are no rows.
    """

    def search(items: Items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in cut(batches):
                ids = batch.column("doc_id").to_pylist()
                found = [
                    (ids[text], items.ids[item], *rest)
                    for text, item, *rest in leaks(items, *utf8(batch.column("text")))
                ]
                if found:
                    columns = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, LEAKS, strict=True)], schema=LEAKS
                    )

        return run

    schema = from_arrow_schema(LEAKS)
    result = docs.sparkSession.createDataFrame([], schema)
    for items in blocks(docs, benchmark, rank):
        result = result.union(texts(docs).mapInArrow(search(items), schema))
    return result


def without_leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns; no shuffle."""

    def search(items: Items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in cut(batches):
                clean = np.ones(batch.num_rows, dtype=bool)
                for text, *_ in leaks(items, *utf8(batch.column("text").fill_null(""))):
                    clean[text] = False
                yield batch.filter(pa.array(clean))

        return run

    kept = docs.withColumn("text", F.col("text").cast("string"))
    for items in blocks(docs, benchmark, rank):
        kept = kept.mapInArrow(search(items), kept.schema)
    return kept
