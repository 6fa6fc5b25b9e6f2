"""Quality classifier: a generalised additive model with pairwise interactions.

Texts become a few numbers; each number falls into one of a fixed set of bins. Shallow trees are boosted
over one number at a time, in turns, and what they add is summed per bin, so the trained model is one lookup
table per number. Then tables over pairs of numbers are boosted the same way. A score is the sum of one
table entry per number and pair, through the logistic function.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lanehouse.llm.frames import cut, remainder, texts, utf8
from lanehouse.llm.words import LOWER, mix, span_hashes, word_spans

#: labelled rows that training uses at most: those with the smallest hash of their id
SAMPLE_ROWS = 20_000
THRESHOLD = 0.7

BINS, PAIR_BINS, PAIRS = 48, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAVES = 120, 60, 0.1, 4
#: Newton weight that a leaf needs, and what is added to it
LEAF_WEIGHT, SHRINK = 4.0, 1.0

FEATURES = (
    "log_bytes", "log_words", "word_length", "word_spread", "space_share", "line_feed_share", "digit_share",
    "upper_share", "stop_share", "comma_share", "symbol_share", "bar_share", "high_share",
    "distinct_share", "repeat_share", "repeat_far_share", "top_share", "short_share", "upper_word_share",
    "line_length", "log_lines", "distinct_line_share",
)

_CLASSES = ("space", "feed", "digit", "upper", "stop", "comma", "symbol", "bar", "high", "lower")
_CLASS = np.full(256, _CLASSES.index("symbol"), dtype=np.int64)
for _name, _bytes in {
    "space": b" \t\r\x0b\x0c", "feed": b"\n", "digit": b"0123456789", "stop": b".!?", "comma": b",;:'\"-()",
    "bar": b"|<>{}[]=/\\_", "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)),
    "high": bytes(range(128, 256)),
}.items():
    _CLASS[list(_bytes)] = _CLASSES.index(_name)
_NOT_FEED = np.zeros(256, dtype=bool)
_NOT_FEED[0x0A] = True


def _distinct(keys: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text the number of distinct keys, and how often its most frequent one occurs."""
    own = mix(keys ^ mix(text.astype(np.uint64) + np.uint64(1)))
    _, first, times = np.unique(own, return_index=True, return_counts=True)
    top = np.zeros(n)
    np.maximum.at(top, text[first], times)
    return np.bincount(text[first], minlength=n), top


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of ``FEATURES`` per text; all are 0 for the empty text."""
    n = len(bounds) - 1
    size = np.diff(bounds).astype(float)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    classes = np.bincount(owner * len(_CLASSES) + _CLASS[data], minlength=n * len(_CLASSES))
    share = dict(
        zip(_CLASSES, (classes.reshape(n, -1) / np.maximum(size, 1)[:, None]).T, strict=True)
    )
    starts, ends, text = word_spans(data, bounds)
    words = np.bincount(text, minlength=n).astype(float)
    each = np.maximum(words, 1)
    length = (ends - starts).astype(float)
    mean = np.bincount(text, length, n) / each
    spread = np.sqrt(np.maximum(np.bincount(text, length**2, n) / each - mean**2, 0))
    keys = span_hashes(LOWER[data], starts, ends)
    distinct, top = _distinct(keys, text, n)

    def repeats(step: int) -> np.ndarray:
        same = (keys[step:] == keys[:-step]) & (text[step:] == text[:-step])
        return np.bincount(text[step:][same], minlength=n) / each

    uppers = np.concatenate([[0], np.cumsum(_CLASS[data] == _CLASSES.index("upper"))])
    capital = (length > 1) & (uppers[ends] - uppers[starts] >= np.maximum(length - 3, 2))
    line_starts, line_ends, line_text = word_spans(data, bounds, _NOT_FEED)
    lines = np.bincount(line_text, minlength=n)
    line_keys = span_hashes(data, line_starts, line_ends)
    some = np.maximum(lines, 1)
    columns = {
        "log_bytes": np.log1p(size),
        "log_words": np.log1p(words),
        "word_length": mean,
        "word_spread": spread,
        **{f"{k}_share": share[k] for k in ("space", "digit", "upper", "stop", "comma", "symbol", "bar", "high")},
        "line_feed_share": share["feed"],
        "distinct_share": distinct / each,
        "repeat_share": repeats(1),
        "repeat_far_share": sum(repeats(step) for step in (2, 3, 4)),
        "top_share": top / each,
        "short_share": np.bincount(text[length <= 3], minlength=n) / each,
        "upper_word_share": np.bincount(text[capital], minlength=n) / each,
        "line_length": size / some,
        "log_lines": np.log1p(lines),
        "distinct_line_share": _distinct(line_keys, line_text, n)[0] / some,
    }
    return np.column_stack([columns[name] for name in FEATURES])


@dataclass
class Additive:
    """Lookup tables: per feature the bin edges and a value per bin, per pair a value per pair of bins."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    coarse: list[np.ndarray] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for column, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, column], side="right")]
        for (i, j), table in self.pairs.items():
            total += table[
                np.searchsorted(self.coarse[i], x[:, i], side="right"),
                np.searchsorted(self.coarse[j], x[:, j], side="right"),
            ]
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _split(g: np.ndarray, h: np.ndarray, low: int, high: int) -> tuple[float, int]:
    """The best cut of bins ``low`` to ``high``, and what it gains."""
    left_g, left_h = np.cumsum(g[low:high])[:-1], np.cumsum(h[low:high])[:-1]
    if not len(left_g):
        return 0.0, low
    all_g, all_h = g[low:high].sum(), h[low:high].sum()
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g**2 / (left_h + SHRINK) + right_g**2 / (right_h + SHRINK) - all_g**2 / (all_h + SHRINK)
    gain[(left_h < LEAF_WEIGHT) | (right_h < LEAF_WEIGHT)] = 0
    best = int(gain.argmax())
    return float(gain[best]), low + best + 1


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of at most ``LEAVES`` leaves over the bins, as a value per bin."""
    leaves = [(0, len(g))]
    while len(leaves) < LEAVES:
        gain, cut_at, leaf = max((*_split(g, h, *leaf), leaf) for leaf in leaves)
        if gain <= 1e-9:
            break
        leaves.remove(leaf)
        leaves += [(leaf[0], cut_at), (cut_at, leaf[1])]
    values = np.zeros(len(g))
    for low, high in leaves:
        values[low:high] = RATE * g[low:high].sum() / (h[low:high].sum() + SHRINK)
    return values


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a pair of features into four fields, as a value per cell."""
    sums = [np.pad(m.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for m in (g, h)]
    best, found = 0.0, np.zeros_like(g)
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            parts = []
            for s in sums:
                a, b, c, d = s[i, j], s[i, -1], s[-1, j], s[-1, -1]
                parts.append(np.array([a, b - a, c - a, d - b - c + a]))
            if (parts[1] < LEAF_WEIGHT).sum() > 2:
                continue
            value = parts[0] / (parts[1] + SHRINK)
            gain = float((parts[0] * value).sum())
            if gain > best:
                best = gain
                found = np.empty_like(g)
                found[:i, :j], found[:i, j:], found[i:, :j], found[i:, j:] = RATE * value
    return best, found


def train(x: np.ndarray, y: np.ndarray) -> Additive:
    """Boost the tables over the rows of ``x`` with labels ``y`` (0 or 1).

    Without rows, or with one label only, the model is a constant: near that label, and 1 without rows.
    """
    if len(y) == 0 or y.min() == y.max():
        return Additive(base=35.0 if len(y) == 0 or y[0] > 0 else -35.0)
    model = Additive(base=float(np.log(y.mean() / (1 - y.mean()))))
    model.edges = [_edges(x[:, k], BINS) for k in range(x.shape[1])]
    model.coarse = [_edges(x[:, k], PAIR_BINS) for k in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.edges)]
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, table in enumerate(model.tables):
            g, h = slopes()
            step = _tree(
                np.bincount(bins[k], g, len(table)), np.bincount(bins[k], h, len(table))
            )
            table += step
            total += step[bins[k]]
    rough = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.coarse)]
    sizes = [len(e) + 1 for e in model.coarse]

    def cells(i: int, j: int) -> tuple[float, np.ndarray]:
        g, h = slopes()
        place = rough[i] * sizes[j] + rough[j]
        return _quadrants(
            *(np.bincount(place, v, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j]) for v in (g, h))
        )

    gains = sorted(
        ((cells(i, j)[0], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True
    )
    chosen = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
    model.pairs = {(i, j): np.zeros((sizes[i], sizes[j])) for i, j in chosen}
    for _ in range(PAIR_ROUNDS):
        for i, j in chosen:
            step = cells(i, j)[1]
            model.pairs[i, j] += step
            total += step[rough[i], rough[j]]
    return model


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Additive:
    """The model for ``labels.quality``, from at most ``sample`` labelled rows that are not held out.

    Of several labels for one id the more frequent counts, 1 of equally frequent ones. The ids with the
    smallest hash are taken, so the sample is broadcast to the scan of the texts.
    """
    known = (
        labels.where((remainder(4) != 2) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    schema = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("x", pa.list_(pa.float64()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            x = features(*utf8(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(list(x), schema.field(2).type)],
                schema=schema,
            )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(known), "doc_id"
    )
    # repeated ids can bring more rows than ids: the bound holds for rows as well
    measured = texts(chosen, "quality").mapInArrow(measure, from_arrow_schema(schema))
    rows = measured.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample).toPandas()
    x = np.array(rows["x"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    return train(x, rows["quality"].to_numpy(dtype=float))


def score(docs: DataFrame, model: Additive, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 if the score reaches ``threshold``) per row.

    NULL text is the empty text, whose features are all 0; a NULL ``doc_id`` stays; equal texts have
    equal scores; other columns are ignored; no rows give none.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("held_out", pa.bool_()),
            ("score", pa.float64()),
            ("predicted", pa.int32()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            found = model.scores(features(*utf8(batch.column("text"))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(found),
                    pa.array((found >= threshold).astype(np.int32)),
                ],
                schema=schema,
            )

    held_out = (remainder(4) == 2).alias("held_out")
    return texts(docs, held_out).mapInArrow(run, from_arrow_schema(schema))


def accepted(docs: DataFrame, model: Additive, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, with all their columns; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            text = batch.column("text").fill_null("")
            yield batch.filter(pa.array(model.scores(features(*utf8(text))) >= threshold))

    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.schema)
