"""Whole trained models against plain versions of them: features, training and prediction, step by step."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lanehouse.llm import languages, quality
from lanehouse.llm.queries import QUERIES

KINDS = {
    "space": b" \t\r\x0b\x0c", "line_feed": b"\n", "digit": b"0123456789", "stop": b".!?", "comma": b",;:'\"-()",
    "bar": b"|<>{}[]=/\\_", "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)),
    "high": bytes(range(128, 256)),
}


def plain_features(text):
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    low = [w.lower() for w in words]
    lines = [line for line in data.split(b"\n") if line]
    n, some = max(len(words), 1), max(len(lines), 1)
    kinds = Counter(next((k for k, own in KINDS.items() if b in own), "symbol") for b in data)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / n
    found = {f"{k}_share": kinds[k] / max(len(data), 1) for k in (*KINDS, "symbol")}
    same = lambda step: sum(a == b for a, b in zip(low, low[step:], strict=False)) / n
    capitals = [sum(b in KINDS["upper"] for b in w) for w in words]
    found |= {
        "log_bytes": math.log1p(len(data)),
        "log_words": math.log1p(len(words)),
        "word_length": mean,
        "word_spread": math.sqrt(max(sum(x * x for x in lengths) / n - mean**2, 0)),
        "distinct_share": len(set(low)) / n,
        "repeat_share": same(1),
        "repeat_far_share": same(2) + same(3) + same(4),
        "top_share": max(Counter(low).values(), default=0) / n,
        "short_share": sum(x <= 3 for x in lengths) / n,
        "upper_word_share": sum(x > 1 and c >= max(x - 3, 2) for x, c in zip(lengths, capitals, strict=True)) / n,
        "line_length": len(data) / some,
        "log_lines": math.log1p(len(lines)),
        "distinct_line_share": len(set(lines)) / some,
    }
    return [found[name] for name in quality.FEATURES]


def test_features_of_documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    texts = [r.text or "" for r in rows] + ["", "\n\n", "A\tBB  CCC DDDd\x0b|é|", "no no NO\nno no\n\nno"]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    bounds = np.cumsum([0, *(len(t.encode()) for t in texts)])
    assert np.allclose(quality.features(data, bounds), [plain_features(t) for t in texts], atol=1e-9)


def plain_tree(g, h):
    """At most four leaves over the bins, each step splitting the leaf that gains most, as steps per bin."""
    leaves = [(0, len(g))]

    def value(low, high):
        return sum(g[low:high]), sum(h[low:high])

    while len(leaves) < quality.LEAVES:
        best = (1e-9, None, None)
        for leaf in leaves:
            all_g, all_h = value(*leaf)
            for at in range(leaf[0] + 1, leaf[1]):
                (a, x), (b, y) = value(leaf[0], at), value(at, leaf[1])
                if min(x, y) >= quality.LEAF_WEIGHT:
                    gain = a * a / (x + 1) + b * b / (y + 1) - all_g**2 / (all_h + 1)
                    if gain > best[0] + 1e-12:
                        best = (gain, leaf, at)
        if best[1] is None:
            break
        leaves.remove(best[1])
        leaves += [(best[1][0], best[2]), (best[2], best[1][1])]
    steps = [0.0] * len(g)
    for low, high in leaves:
        a, x = value(low, high)
        steps[low:high] = [quality.RATE * a / (x + 1)] * (high - low)
    return steps


def plain_fields(g, h):
    """The best cross through a table of cells, as the gain and steps per cell."""
    best = (0.0, {cell: 0.0 for cell in g})
    n, m = (max(cell[k] for cell in g) + 1 for k in (0, 1))
    for i in range(1, n):
        for j in range(1, m):
            sums = {}
            for (a, b), value in g.items():
                field = sums.setdefault((a >= i, b >= j), [0.0, 0.0])
                field[0] += value
                field[1] += h[a, b]
            if sum(field[1] < quality.LEAF_WEIGHT for field in sums.values()) > 2:
                continue
            gain = sum(a * a / (x + 1) for a, x in sums.values())
            if gain > best[0] + 1e-12:
                step = {f: quality.RATE * a / (x + 1) for f, (a, x) in sums.items()}
                best = (gain, {(a, b): step[a >= i, b >= j] for a, b in g})
    return best


class Plain:
    """Boosting row by row: the same edges, one shallow tree per feature in turn, then pairs."""

    def __init__(self, x, y):
        self.base = math.log(sum(y) / (len(y) - sum(y)))
        columns = range(len(x[0]))
        cut = lambda k, bins: sorted({*np.quantile([r[k] for r in x], np.linspace(0, 1, bins + 1)[1:-1]).tolist()})
        self.fine, self.rough = ([cut(k, n) for k in columns] for n in (quality.BINS, quality.PAIR_BINS))
        self.tables = [[0.0] * (len(e) + 1) for e in self.fine]
        self.pairs = {}
        for _ in range(quality.ROUNDS):
            for k in columns:
                steps = plain_tree(*self.slopes(x, y, lambda r, k=k: self.bin(self.fine, r, k), range(len(self.tables[k]))))
                self.tables[k] = [a + b for a, b in zip(self.tables[k], steps, strict=True)]
        cells = {
            (i, j): [(a, b) for a in range(len(self.rough[i]) + 1) for b in range(len(self.rough[j]) + 1)]
            for i in columns for j in range(i)
        }
        gains = sorted(((self.fields(x, y, i, j, own)[0], i, j) for (i, j), own in cells.items()), reverse=True)
        chosen = [(i, j) for gain, i, j in gains[: quality.PAIRS] if gain > 0]
        self.pairs = {pair: dict.fromkeys(cells[pair], 0.0) for pair in chosen}
        for _ in range(quality.PAIR_ROUNDS):
            for i, j in chosen:
                for cell, step in self.fields(x, y, i, j, cells[i, j])[1].items():
                    self.pairs[i, j][cell] += step

    @staticmethod
    def bin(edges, row, k):
        return sum(row[k] >= e for e in edges[k])

    def total(self, row):
        found = self.base + sum(t[self.bin(self.fine, row, k)] for k, t in enumerate(self.tables))
        return found + sum(t[self.bin(self.rough, row, i), self.bin(self.rough, row, j)] for (i, j), t in self.pairs.items())

    def score(self, row):
        return 1 / (1 + math.exp(-max(-35, min(35, self.total(row)))))

    def slopes(self, x, y, place, places):
        g, h = dict.fromkeys(places, 0.0), dict.fromkeys(places, 0.0)
        for row, label in zip(x, y, strict=True):
            p = 1 / (1 + math.exp(-self.total(row)))
            g[place(row)] += label - p
            h[place(row)] += p * (1 - p)
        return ([d[p] for p in places] for d in (g, h)) if isinstance(places, range) else (g, h)

    def fields(self, x, y, i, j, cells):
        return plain_fields(*self.slopes(x, y, lambda r: (self.bin(self.rough, r, i), self.bin(self.rough, r, j)), cells))


@pytest.mark.parametrize("seed", range(3))
def test_training_is_that_of_a_plain_version(monkeypatch, seed):
    for name, value in {"BINS": 9, "PAIR_BINS": 4, "PAIRS": 2, "ROUNDS": 6, "PAIR_ROUNDS": 5}.items():
        monkeypatch.setattr(quality, name, value)
    rng = np.random.default_rng(seed)
    x = rng.random((160, 4)).round(2)
    y = ((x[:, 0] > 0.4) ^ (x[:, 1] > 0.6)) | (x[:, 2] > 0.8)
    y = np.where(rng.random(160) < 0.1, ~y, y).astype(float)
    model, plain = quality.train(x, y), Plain(x.tolist(), y.tolist())
    assert model.pairs.keys() == plain.pairs.keys()
    for own, table in zip(model.tables, plain.tables, strict=True):
        assert np.allclose(own, table)
    for (i, j), table in model.pairs.items():
        assert np.allclose(table, [[plain.pairs[i, j][a, b] for b in range(table.shape[1])] for a in range(table.shape[0])])
    fresh = rng.random((50, 4))
    assert np.allclose(model.scores(fresh), [plain.score(row) for row in fresh.tolist()])


def test_scores_of_documents_by_a_plain_version(spark, sf_dir, monkeypatch):
    for name, value in {"BINS": 12, "PAIR_BINS": 4, "PAIRS": 2, "ROUNDS": 3, "PAIR_ROUNDS": 2}.items():
        monkeypatch.setattr(quality, name, value)
    docs = {r.doc_id: plain_features(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held_out = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in docs}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    taught = [(docs[r.doc_id], r.quality) for r in labels if r.doc_id in docs and not held_out[r.doc_id] and r.quality is not None]
    plain = Plain([x for x, _ in taught], [float(label) for _, label in taught])
    got = QUERIES["op6_quality_classifier"](spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        assert math.isclose(r.score, plain.score(docs[r.doc_id]), abs_tol=1e-6)
        assert (r.held_out, r.predicted) == (held_out[r.doc_id], int(r.score >= 0.7))


def plain_vector(text, known):
    """The sum of the vectors of a text's letter triples, each made once."""
    marks = [c.lower()[0] if c.isalpha() else "\0" for c in text or ""]
    found = Counter(
        (marks[k - 1] if k else "\0", c, marks[k + 1] if k + 1 < len(marks) else "\0")
        for k, c in enumerate(marks) if c != "\0"
    )
    total = np.zeros(languages.DIMENSION)
    for triple, n in found.items():
        if triple not in known:
            a, b, c = (languages.letter_vectors(np.array([ord(x)]))[0].astype(float) for x in triple)
            known[triple] = np.roll(a, 2) * np.roll(b, 1) * c
        total += n * known[triple]
    return total


def test_prototypes_and_predictions_by_a_plain_version(spark, sf_dir):
    docs, known = spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), {}
    vectors = {r.doc_id: plain_vector(r.text, known) for r in docs}
    held_out = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in vectors}
    sums: dict = {}
    for r in docs:
        if r.lang is not None and not held_out[r.doc_id]:
            sums[r.lang] = sums.get(r.lang, 0) + vectors[r.doc_id]
    names = sorted(sums)
    got = QUERIES["op8_language_id"](spark, sf_dir).collect()
    assert len(got) == len(docs) and len(names) > 2
    for r in got:
        own, size = vectors[r.doc_id], np.linalg.norm(vectors[r.doc_id])
        if size == 0:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosines = [own @ sums[name] / size / np.linalg.norm(sums[name]) for name in names]
        assert r.held_out == held_out[r.doc_id] and r.lang_pred == names[int(np.argmax(cosines))]
        assert math.isclose(r.score, max(cosines), abs_tol=1e-4)
