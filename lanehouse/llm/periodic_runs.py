"""Runs of words that repeat with a period.

A run is a longest stretch of consecutive words with smallest period q, of ``least`` words and two periods
at least. Every word of a run occurs in it twice or more. So a word that occurs once in a segment belongs to
no run of it and splits it; the pieces, in which words have become rarer, are split again until nothing
changes. What is left is compared with itself at every lag at which a run may still fit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lanehouse.llm.frames import cut, texts

#: white space between words, as a pattern
SPACE = r"[\x20\x09-\x0D]+"
LEAST_WORDS = 12

#: rounds in which all segments are split together; what still changes then is split one by one
ROUNDS = 64
#: lags that are compared at every word; beyond them a run has enough words to be met at every eighth of its lag
EVERY_WORD = 64
SAMPLES = 8

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())]
)


def segments(ids: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the segments in which every word occurs twice at least.

    ``ids`` numbers the words, ``bounds`` are the offsets of the texts. Segments shorter than ``least`` go.
    """
    size = len(ids)
    before, after = np.full(size, -1), np.full(size, size)
    order = np.argsort(ids, kind="stable")
    same = ids[order[1:]] == ids[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    after[order[:-1][same]] = order[1:][same]
    starts, ends = bounds[:-1], bounds[1:]
    done: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(ROUNDS):
        long = ends - starts >= least
        starts, ends = starts[long], ends[long]
        lengths = ends - starts
        if not len(starts):
            break
        place = np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
        lone = (before[place] < np.repeat(starts, lengths)) & (after[place] >= np.repeat(ends, lengths))
        number = np.repeat(np.arange(len(starts)), lengths)[lone]
        splits = np.bincount(number, minlength=len(starts)) > 0
        done.append((starts[~splits], ends[~splits]))
        at = place[lone]
        starts = np.sort(np.concatenate([starts[splits], at + 1]))
        ends = np.sort(np.concatenate([ends[splits], at]))
    else:
        done += [split_from_ends(before, after, a, b, least) for a, b in zip(starts, ends, strict=True)]
    return joined(done)


def joined(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *(a for a, _ in pairs)]), np.concatenate([none, *(b for _, b in pairs)])


def split_from_ends(before, after, start: int, end: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The segments of one, looked through from both ends at once: each split costs its smaller part."""
    waiting, starts, ends = [(int(start), int(end))], [], []
    while waiting:
        start, end = waiting.pop()
        if end - start < least:
            continue
        for step in range((end - start + 1) // 2):
            here = (start + step, end - 1 - step)
            at = next((i for i in here if before[i] < start and after[i] >= end), None)
            if at is not None:
                waiting += [(start, at), (at + 1, end)]
                break
        else:
            starts.append(start)
            ends.append(end)
    return np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64)


def stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of at least ``least`` true values."""
    edges = np.flatnonzero(np.diff(same, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def at_lag(row: np.ndarray, lag: int, need: int, known: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of ``need`` places that equal those ``lag`` further on.

    Beyond ``EVERY_WORD``, where ``need`` is the lag, only every eighth of the lag is compared; places around
    eight hits in a row are then looked at one by one, unless a ``known`` run whose period divides the lag
    covers them all: what it gives at this lag ends where it does, and its period is smaller.
    """
    if lag <= EVERY_WORD:
        return stretches(row[:-lag] == row[lag:], need)
    step = lag // SAMPLES
    size = len(row) - lag
    firsts, lasts = stretches(row[:size:step] == row[lag::step], lag // step)
    found = []
    for first, last in zip((firsts * step).tolist(), ((lasts - 1) * step).tolist(), strict=True):
        if any(
            np.any((begins <= first) & (stops > last + lag) & (lag % periods == 0))
            for begins, stops, periods in known
        ):
            continue
        low, high = max(0, first - step + 1), min(size, last + step)
        starts, ends = stretches(row[low:high] == row[low + lag : high + lag], need)
        found.append((starts + low, ends + low))
    return joined(found)


def scan_lags(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """Rows (start, length, period) of all runs in the segments, by start and period.

    The segments, the longest first, stand in one row with a number of its own after each, so that a lag
    meets all segments that are long enough for it at once. A stretch of equal places that reaches into
    the next segment is shorter than its lag.
    """
    order = np.argsort(starts - ends, kind="stable")
    starts, lengths = starts[order], (ends - starts)[order]
    if not len(starts):
        return np.zeros((0, 3), dtype=np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1
    shift = starts - begins
    row = np.empty(begins[-1] + lengths[-1] + 1, dtype=np.int64)
    inside = np.ones(len(row), dtype=bool)
    inside[begins + lengths] = False
    row[~inside] = -1 - np.arange(len(starts))
    row[inside] = ids[np.flatnonzero(inside) + np.repeat(shift, lengths)]
    row = row.astype(np.int32)
    known: list[tuple] = []
    for lag in range(1, int(lengths[0]) // 2 + 1):
        fits = int(np.searchsorted(-lengths, -max(least, 2 * lag), side="right"))
        if not fits:
            break
        part = row[: begins[fits - 1] + lengths[fits - 1]]
        firsts, lasts = at_lag(part, lag, max(least - lag, lag), known)
        if len(firsts):
            known.append((firsts, lasts + lag, np.full(len(firsts), lag)))
    if not known:
        return np.zeros((0, 3), dtype=np.int64)
    first, stop, period = (np.concatenate(column) for column in zip(*known, strict=True))
    # the same words at a multiple of their period: the smallest one counts
    order = np.lexsort((period, stop, first))
    first, stop, period = first[order], stop[order], period[order]
    own = np.ones(len(first), dtype=bool)
    own[1:] = (first[1:] != first[:-1]) | (stop[1:] != stop[:-1])
    first, stop, period = first[own], stop[own], period[own]
    start = first + shift[np.searchsorted(begins, first, side="right") - 1]
    order = np.lexsort((period, start))
    return np.stack([start, stop - first, period], axis=1)[order]


def split_words(array: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and the offsets of the texts among them."""
    lists = pc.ascii_split_whitespace(array)
    words, parent = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    full = pc.greater(pc.binary_length(words), 0)
    parent = parent[full.to_numpy(zero_copy_only=False)]
    return words.filter(full), np.searchsorted(parent, np.arange(len(array) + 1))


def find_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """A row per document: ``doc_id``, ``n_words``, its ``runs`` and the ``collapsed`` text without them.

    A run has start, length and period. Words are what stands between ASCII white space, numbered from 0;
    ``runs`` come by start and period. A run's words after its first period are dropped, the rest makes
    ``collapsed``, joined by one space. NULL and empty texts have no words; a NULL ``doc_id`` stays, repeated
    rows are rows each, other columns are ignored, no rows give none. Work is done in the scan, without a
    shuffle; a text is looked at whole.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            words, bounds = split_words(batch.column("text"))
            coded = words.dictionary_encode()
            ids = coded.indices.to_numpy().astype(np.int64)
            runs = scan_lags(ids, *segments(ids, bounds, least), least)
            start, length, period = runs.T
            steps = np.zeros(len(ids) + 1, dtype=np.int64)
            np.add.at(steps, start + period, 1)
            np.add.at(steps, start + length, -1)
            stays = np.cumsum(steps)[:-1] == 0
            left = np.concatenate([[0], np.cumsum(stays)])[bounds].astype(np.int32)
            kept = pa.ListArray.from_arrays(left, words.filter(pa.array(stays)))
            doc = np.searchsorted(bounds, start, side="right") - 1
            listed = pa.StructArray.from_arrays(
                [pa.array(c) for c in (start - bounds[doc], length, period)], fields=list(RUN)
            )
            own = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(bounds)),
                    pa.ListArray.from_arrays(own, listed),
                    pc.binary_join(kept, " ").cast(pa.string()),
                ],
                schema=FOUND,
            )

    return texts(docs).mapInArrow(search, from_arrow_schema(FOUND))


def with_repeats(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth, by the checksum of its id, gets an end that repeats.

    With h the crc32 of the decimal ``doc_id`` and g = h // 10, a text of n > 0 words with h % 10 = 0 keeps
    its words before a = g % n; from there it repeats the p = 1 + (n - a) // (3 + g % 8) words at a. Its
    words are then joined by one space. Texts of a NULL ``doc_id`` stay as they are.
    """
    given = texts(docs).withColumn("_h", F.crc32(F.col("doc_id").cast("string")))
    words = F.when(
        F.col("_h") % 10 == 0, F.filter(F.split("text", SPACE), lambda word: word != "")
    )
    given = given.withColumn("_words", words).withColumn("_n", F.size("_words").cast("long"))
    g = F.expr("_h div 10")
    counted = given.withColumn("_a", F.when(F.col("_n") > 0, g % F.greatest("_n", F.lit(1))))
    p = 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + g % 8))

    def part(array: Column | str, start: Column, length: Column) -> Column:
        return F.slice(array, start.cast("int"), length.cast("int"))

    left = F.col("_n") - F.col("_a")
    cycle = part("_words", F.col("_a") + 1, p)
    repeated = F.flatten(F.array_repeat(cycle, F.ceil(left / p).cast("int")))
    whole = F.concat(part("_words", F.lit(1), F.col("_a")), part(repeated, F.lit(1), left))
    return counted.select(
        "doc_id",
        F.when(F.col("_a").isNotNull(), F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"),
    )


def digests(found: DataFrame) -> DataFrame:
    """``find_runs`` in numbers: how many runs, the longest (then first) one, and checksums."""
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
            ),
        )
    )
    length, start, period = best["length"], -best["start"], -best["period"]
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
