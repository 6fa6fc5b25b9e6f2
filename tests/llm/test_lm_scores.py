"""Language-model scores against plain counting in dictionaries."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from rows import no_rows, odd

from lanehouse.llm import exchange, lm_scores
from lanehouse.llm.queries import QUERIES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER)), None]


def pairs(words):
    return list(zip([None, *words[:-1]], words, strict=True))


def span(count):
    return min(count.bit_length(), lm_scores.RANGES - 1)


class Model:
    def __init__(self, texts):
        self.words = Counter(w for t in texts for w in tokens(t))
        self.pairs = Counter(p for t in texts for p in pairs(tokens(t)))
        self.n = sum(self.words.values())

    def parts(self, pair):
        context = self.words[pair[0]]
        return np.array(
            [
                1 / (len(self.words) + 1),
                self.words[pair[1]] / max(self.n, 1),
                self.pairs[pair] / context if context else 0.0,
            ]
        )


def by_hand(rows):
    part = [zlib.crc32(str("" if i is None else i).encode()) % 10 for i, _ in rows]
    main = Model([t for (_, t), p in zip(rows, part, strict=True) if p > 1])
    events = Counter(x for (_, t), p in zip(rows, part, strict=True) if p == 1 for x in pairs(tokens(t)))
    weights = np.full((lm_scores.RANGES, 3), 1 / 3)
    for _ in range(lm_scores.ROUNDS):
        expected = np.full((lm_scores.RANGES, 3), lm_scores.PRIOR)
        for pair, n in events.items():
            k = span(main.words[pair[0]])
            share = weights[k] * main.parts(pair)
            expected[k] += n * share / share.sum()
        following = expected / expected.sum(axis=1, keepdims=True)
        change = abs(following - weights).max()
        weights = following
        if change < lm_scores.SETTLED:
            break
    model = Model([t for (_, t), p in zip(rows, part, strict=True) if p])
    size = model.n + 0.1 * (len(model.words) + 1)
    for (i, text), p in zip(rows, part, strict=True):
        own = tokens(text)
        base = sum(math.log10((model.words[w] + 0.1) / size) for w in own)
        score = sum(
            math.log10(weights[span(model.words[pair[0]])] @ model.parts(pair)) for pair in pairs(own)
        )
        yield i, p == 0, len(own), sum(model.words[w] > 0 for w in own), model.n, base, score


def check(got, rows):
    expected = sorted(by_hand(rows), key=lambda r: (repr(r[0]), r[5]))
    got = sorted(map(tuple, got.collect()), key=lambda r: (repr(r[0]), r[5]))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[5:] == pytest.approx(e[5:], rel=1e-6)


def test_documents(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(QUERIES["op4_lm_scores"](spark, sf_dir), rows)


def test_many_chunks_and_buckets(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    monkeypatch.setattr(lm_scores, "CHUNK_BYTES", 10_000)
    monkeypatch.setattr(lm_scores, "bucket_bits", lambda keys: exchange.bucket_bits(keys, 500))
    check(lm_scores.score_texts(docs.repartition(3)), rows)


def test_odd_rows(spark):
    docs = odd(spark, 3_000)
    check(lm_scores.score_texts(docs), [(r.doc_id, r.text) for r in docs.collect()])
    assert lm_scores.score_texts(no_rows(spark)).collect() == []
    untaught = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    (row,) = lm_scores.score_texts(untaught).collect()
    assert row[:5] == (None, True, 3, 0, 0) and row.base_score == pytest.approx(0) and math.isfinite(row.score)


def test_the_model_is_better_than_single_words_on_held_out_texts(spark):
    got = QUERIES["op4_lm_scores"](spark, "/root/testdata/sf0.01").where("held_out")
    row = got.selectExpr("sum(score) as s", "sum(base_score) as b").first()
    assert row.s > row.b
