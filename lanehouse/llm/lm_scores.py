"""Language-model scores by deleted interpolation.

The probability of a word after another mixes three estimates: the share of that pair among all pairs with the
first word, the word's share of all words, and one over the vocabulary. How they are mixed depends on how
often the first word was seen: each range of that frequency has weights of its own. The weights are learned
by expectation-maximisation on documents that the counts under them don't include; the scores then use the
counts of all training documents.

Counts are exact and over all documents. Documents are put into chunks that hold their words in encoded form;
every chunk asks for the counts of its distinct words and pairs, see ``exchange``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lanehouse.llm.exchange import ask, bucket_bits, bucket_edges, with_answers
from lanehouse.llm.frames import cut, gathered, keep, packed, remainder, texts, unpacked, utf8
from lanehouse.llm.words import mix, words_of

CHUNK_BYTES = 4 << 20
#: of ten parts of the documents: the one that is only scored, and the one the weights are learned on
PARTS, HELD_OUT, TUNING = 10, 0, 1
#: the added count of the plain estimate
ADDED = 0.1

#: what ends a text, and stands before the first word of one
END = np.uint64(0x1F0E2D3C4B5A6978)
#: ranges of context frequency: 0, 1, 2-3, 4-7 and so on
RANGES = 48
ROUNDS, SETTLED = 40, 1e-4
#: events that each estimate has in each range before any is seen
PRIOR = 0.01

CHUNKS = pa.schema(
    [
        ("chunk", pa.int64()),
        ("tuning", pa.bool_()),
        ("doc_ids", pa.list_(pa.int64())),
        ("parts", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int64())),
        ("tokens", pa.binary()),
        ("words", pa.binary()),
        ("n_keys", pa.int64()),
        ("n_train", pa.int64()),
    ]
)
REQUESTS = pa.schema(
    [
        ("chunk", pa.int64()),
        ("bucket", pa.int32()),
        ("tuning", pa.bool_()),
        ("words", pa.binary()),
        ("word_counts", pa.binary()),
        ("pairs", pa.binary()),
        ("pair_counts", pa.binary()),
    ]
)
ANSWERS = pa.schema(
    [
        ("chunk", pa.int64()),
        ("bucket", pa.int32()),
        ("word_main", pa.binary()),
        ("word_tuning", pa.binary()),
        ("pair_main", pa.binary()),
        ("pair_tuning", pa.binary()),
        ("new_main", pa.int64()),
        ("new_all", pa.int64()),
    ]
)
EVENTS = pa.schema(
    [
        ("range", pa.int32()),
        ("pair", pa.int64()),
        ("context", pa.int64()),
        ("word", pa.int64()),
        ("n", pa.int64()),
    ]
)
SCORES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)


def pack_keys(keys: np.ndarray) -> bytes:
    """Rising 64-bit keys as their steps."""
    return packed(np.diff(keys, prepend=np.uint64(0)), "<u8")


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, "<u8"), dtype=np.uint64)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in rising order, and the place of each key among them."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    place = np.empty(len(keys), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[new], place


def token_hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts, each text closed by the end, and the number of tokens per text."""
    hashes, sizes = [], []
    for piece in cut([batch]):
        word, text = words_of(*utf8(piece.column("text")))
        count = np.bincount(text, minlength=piece.num_rows)
        hashes.append(np.insert(word, np.cumsum(count), END))
        sizes.append(count + 1)
    return np.concatenate(hashes), np.concatenate(sizes)


def pair_hashes(tokens: np.ndarray) -> np.ndarray:
    """A hash for each token with the one before it."""
    before = np.concatenate([[END], tokens[:-1]])
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + tokens)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    for whole in gathered(batches, size=CHUNK_BYTES):
        is_tuning = whole.column("part").to_numpy() == TUNING
        for tuning in (False, True):
            batch = whole.filter(pa.array(is_tuning == tuning))
            if not batch.num_rows:
                continue
            tokens, sizes = token_hashes(batch)
            words, place = distinct(tokens)
            parts = batch.column("part").to_numpy()
            row = {
                "chunk": (part << 32) + number,
                "tuning": tuning,
                "doc_ids": batch.column("doc_id").to_pylist(),
                "parts": parts,
                "sizes": sizes,
                "tokens": packed(place),
                "words": pack_keys(words),
                # about how many distinct keys it asks for
                "n_keys": len(words) + len(tokens),
                "n_train": int(sizes[parts != HELD_OUT].sum()),
            }
            number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[f.name]], f.type) for f in CHUNKS], schema=CHUNKS
            )


def _decoded(row: dict):
    """The distinct words of a chunk and the place of each token; its distinct pairs and each token's pair."""
    words = unpack_keys(row["words"])
    place = unpacked(row["tokens"]).astype(np.int64)
    pairs, pair = distinct(pair_hashes(words[place]))
    return words, place, pairs, pair


def _requests(bits: int):
    def requests(batch: pa.RecordBatch) -> Iterator[tuple]:
        (row,) = batch.to_pylist()
        words, place, pairs, pair = _decoded(row)
        counted = np.repeat(np.array(row["parts"]) != HELD_OUT, row["sizes"])
        word_counts = np.bincount(place[counted], minlength=len(words))
        pair_counts = np.bincount(pair[counted], minlength=len(pairs))
        of_words, of_pairs = bucket_edges(words, bits), bucket_edges(pairs, bits)
        for bucket in np.flatnonzero(np.diff(of_words) + np.diff(of_pairs)):
            a, b = slice(*of_words[bucket : bucket + 2]), slice(*of_pairs[bucket : bucket + 2])
            yield (
                row["chunk"], int(bucket), row["tuning"],
                pack_keys(words[a]), packed(word_counts[a]), pack_keys(pairs[b]), packed(pair_counts[b]),
            )

    return requests


def _totals(keys: list[bytes], counts: list[bytes], tuning: np.ndarray):
    """For all requests the summed counts of their keys, in the main part and in the tuning part."""
    keys = [unpack_keys(k) for k in keys]
    sizes = np.array([len(k) for k in keys])
    every, place = distinct(np.concatenate(keys))
    count = np.concatenate([unpacked(c) for c in counts]).astype(np.float64)
    own = np.repeat(tuning, sizes)
    totals = [np.bincount(place, count * (own == t), len(every)).astype(np.int64) for t in (False, True)]
    ends = np.cumsum(sizes)[:-1]
    return totals, [[packed(part) for part in np.split(total[place], ends)] for total in totals]


def _answers(table: pa.Table) -> pa.Table:
    tuning = table.column("tuning").to_numpy()
    column = lambda name: table.column(name).to_pylist()
    (main, other), word_answers = _totals(column("words"), column("word_counts"), tuning)
    _, pair_answers = _totals(column("pairs"), column("pair_counts"), tuning)
    # the first answer of a bucket tells how many words of it the training documents have
    first = np.arange(table.num_rows) == 0
    columns = [
        table.column("chunk"), table.column("bucket"), *word_answers, *pair_answers,
        np.where(first, (main > 0).sum(), 0), np.where(first, (main + other > 0).sum(), 0),
    ]
    return pa.Table.from_arrays(
        [c if isinstance(c, pa.ChunkedArray) else pa.array(c, f.type) for c, f in zip(columns, ANSWERS, strict=True)],
        schema=ANSWERS,
    )


def _counts(row: dict, name: str) -> np.ndarray:
    parts = [unpacked(answer[name]) for answer in row["answers"]]
    return np.concatenate(parts).astype(np.int64)


def context_range(count: np.ndarray) -> np.ndarray:
    """The range of a context's frequency."""
    return np.minimum(np.frexp(count.astype(np.float64))[1], RANGES - 1)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of the batches, one by one: a chunk takes a lot of memory when it is decoded."""
    for batch in batches:
        for number in range(batch.num_rows):
            yield from batch.slice(number, 1).to_pylist()


def _events_of(row: dict) -> pa.RecordBatch:
    """How often each combination of counts occurs among the tokens of a chunk of tuning documents."""
    _, place, _, pair = _decoded(row)
    word, both = _counts(row, "word_main")[place], _counts(row, "pair_main")[pair]
    # the end stands before the first token, and is the last one
    context = np.concatenate([word[-1:], word[:-1]])
    of = context_range(context)
    # a pair that was never seen has the estimate 0 whatever its context
    context = np.where(both > 0, context, 0)
    found = np.column_stack([of, both, context, word])
    order = np.lexsort(found.T[::-1])
    found = found[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]).any(axis=1)
    n = np.diff(np.append(np.flatnonzero(new), len(found)))
    columns = (*found[new].T, n)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, EVENTS, strict=True)], schema=EVENTS
    )


def _events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return map(_events_of, _rows(batches))


def learn_weights(events: DataFrame, tokens: int, vocabulary: int) -> np.ndarray:
    """Three weights for each range of context frequency, by expectation-maximisation over ``events``.

    Spark sums, per range, the share that each estimate has in each event; the driver gets a row per range.
    """
    spark = events.sparkSession
    weights = np.full((RANGES, 3), 1 / 3)
    plain, word = F.lit(1.0 / (vocabulary + 1)), F.col("word") / max(tokens, 1)
    both = F.when(F.col("pair") > 0, F.col("pair") / F.col("context")).otherwise(0.0)
    for _ in range(ROUNDS):
        table = spark.createDataFrame(
            [(k, *map(float, w)) for k, w in enumerate(weights)], "range int, w0 double, w1 double, w2 double"
        )
        # one row per range
        shares = events.join(F.broadcast(table), "range").select(
            "range",
            "n",
            (F.col("w0") * plain).alias("s0"),
            (F.col("w1") * word).alias("s1"),
            (F.col("w2") * both).alias("s2"),
        )
        whole = F.col("n") / (F.col("s0") + F.col("s1") + F.col("s2"))
        sums = shares.groupBy("range").agg(*(F.sum(F.col(f"s{k}") * whole).alias(f"s{k}") for k in range(3)))
        expected = np.full((RANGES, 3), PRIOR)
        for row in sums.collect():
            expected[row.range] += (row.s0, row.s1, row.s2)
        following = expected / expected.sum(axis=1, keepdims=True)
        change = np.abs(following - weights).max()
        weights = following
        if change < SETTLED:
            break
    return weights


def _scores_of(row: dict, weights: np.ndarray, tokens: int, vocabulary: int) -> pa.RecordBatch:
    """The scores of the documents of a chunk."""
    _, place, _, pair = _decoded(row)
    words = _counts(row, "word_main") + _counts(row, "word_tuning")
    both = (_counts(row, "pair_main") + _counts(row, "pair_tuning"))[pair]
    word = words[place]
    context = np.concatenate([word[-1:], word[:-1]])
    weight = weights[context_range(context)]
    mixed = (
        weight[:, 0] / (vocabulary + 1)
        + weight[:, 1] * word / max(tokens, 1)
        + weight[:, 2] * both / np.maximum(context, 1)
    )
    base = (words + ADDED) / (tokens + ADDED * (vocabulary + 1))
    sizes = np.array(row["sizes"])
    first = np.cumsum(sizes) - sizes
    known, plain, score = (
        np.add.reduceat(v, first) for v in ((word > 0).astype(np.int64), np.log10(base)[place], np.log10(mixed))
    )
    held_out = np.array(row["parts"]) == HELD_OUT
    columns = (row["doc_ids"], held_out, sizes, known, np.full(len(sizes), tokens), plain, score)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, SCORES, strict=True)], schema=SCORES
    )


def _scores(weights: np.ndarray, tokens: int, vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (_scores_of(row, weights, tokens, vocabulary) for row in _rows(batches))

    return run


def score_texts(docs: DataFrame) -> DataFrame:
    """Two log10 probabilities per row of ``docs``: of single words with added counts, and of the model.

    Gives ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.
    Tokens are the words, with A to Z in lower case, and one end. Rows whose crc32 of the id is 0 modulo 10
    are held out; the others are counted, each as often as it is repeated. NULL text is empty: its end is its
    only token. A NULL ``doc_id`` hashes as the empty text, which is held out. Without training rows every
    word has the same probability. Other columns are ignored, no rows give none.
    """
    part = remainder(PARTS).alias("part")
    chunks = keep(
        texts(docs, part).mapInArrow(_encode, from_arrow_schema(CHUNKS)), "words"
    )
    keys, tokens, main = chunks.agg(
        *(
            F.coalesce(F.sum(c), F.lit(0))
            for c in (F.col("n_keys"), F.col("n_train"), F.when(~F.col("tuning"), F.col("n_train")))
        )
    ).first()
    bits = bucket_bits(keys)
    replies = keep(ask(chunks, _requests(bits), REQUESTS, _answers, ANSWERS), "counts")
    main_words, all_words = replies.agg(
        *(F.coalesce(F.sum(c), F.lit(0)) for c in ("new_main", "new_all"))
    ).first()
    told = replies.drop("new_main", "new_all")
    tuning = chunks.where("tuning")
    seen = with_answers(tuning, told.join(tuning.select("chunk"), "chunk", "left_semi"))
    events = seen.select("tokens", "words", "answers").mapInArrow(_events, from_arrow_schema(EVENTS))
    events = keep(events.groupBy("range", "pair", "context", "word").agg(F.sum("n").alias("n")), "events")
    weights = learn_weights(events, main, main_words)
    known = with_answers(chunks, told).select("doc_ids", "parts", "sizes", "tokens", "words", "answers")
    return known.mapInArrow(_scores(weights, tokens, all_words), from_arrow_schema(SCORES))
