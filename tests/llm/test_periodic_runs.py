"""Runs of repeating words against looking at every stretch."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from rows import no_rows, odd

from lanehouse.llm import periodic_runs
from lanehouse.llm.queries import QUERIES


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_runs(words, least=12):
    """(start, length, period): for every period the longest stretches, less those of a smaller period."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        start = 0
        for at in range(len(words) - period + 1):
            if at == len(words) - period or words[at] != words[at + period]:
                if at + period - start >= max(least, 2 * period):
                    found.setdefault((start, at + period - start), period)
                start = at + 1
    return sorted((a, n, q) for (a, n), q in found.items())


def plain_left(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plain_row(doc_id, text):
    words = words_of(text)
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    best = min(((-length, start, q) for start, length, q in runs), default=None)
    first = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    lines = "".join(f"{a},{length},{q}\n" for a, length, q in runs)
    return doc_id, len(runs), *first, sha(lines), sha(plain_left(words, runs)), n


def found_in(lists):
    sizes = [len(x) for x in lists]
    ids = np.array([w for x in lists for w in x], dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    runs = periodic_runs.scan_lags(ids, *periodic_runs.segments(ids, bounds, 12), 12)
    by_list = [[] for _ in lists]
    for start, length, period in runs.tolist():
        k = int(np.searchsorted(bounds, start, side="right")) - 1
        by_list[k].append((start - int(bounds[k]), length, period))
    return by_list


def samples(seed, count=60):
    """Lists of few different words, with planted repeats of all kinds."""
    rng = np.random.default_rng(seed)
    for _ in range(count):
        row = rng.integers(0, rng.choice([2, 3, 6, 40]), rng.integers(0, 150)).tolist()
        for _ in range(rng.integers(0, 4)):
            at = int(rng.integers(0, len(row) + 1))
            unit = rng.integers(0, rng.choice([1, 2, 50]), rng.integers(1, 40)).tolist()
            row[at:at] = (unit * 5)[: int(rng.integers(len(unit), 5 * len(unit) + 1))]
        yield row


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("every, rounds", [(64, 64), (6, 64), (6, 1)])
def test_runs_of_lists(monkeypatch, seed, every, rounds):
    # small limits lead all lists through the sampled lags and the splitting one by one
    monkeypatch.setattr(periodic_runs, "EVERY_WORD", every)
    monkeypatch.setattr(periodic_runs, "SAMPLES", 2 if every == 6 else 8)
    monkeypatch.setattr(periodic_runs, "ROUNDS", rounds)
    lists = [*samples(seed), [], [1] * 11, [1] * 12, [1, 2] * 300, [1] * 500 + [2] + [1] * 400]
    assert found_in(lists) == [plain_runs(x) for x in lists]


def test_runs_of_fibonacci_words():
    a, b = [1], [1, 2]
    while len(b) < 1500:
        a, b = b, b + a
    assert found_in([b]) == [plain_runs(b)]


def test_every_segment_is_split_to_the_end():
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.3, 4000) % 500
    bounds = np.array([0, 1500, 1500, 4000])
    for start, end in zip(*periodic_runs.segments(ids, bounds, 12), strict=True):
        assert np.unique(ids[start:end], return_counts=True)[1].min() >= 2


def test_a_long_text_of_one_word_takes_seconds():
    ids = np.zeros(100_000, dtype=np.int64)
    ends = np.array([0, len(ids)])
    assert periodic_runs.scan_lags(ids, ends[:1], ends[1:], 12).tolist() == [[0, 100_000, 1]]


def test_documents(spark, sf_dir):
    got = QUERIES["op11_periodic_runs"](spark, sf_dir)
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        "collapsed_sha256", "n_words",
    ]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = [plain_row(d.doc_id, d.text) for d in docs if len(words_of(d.text)) < 1500]
    kept = {r[0] for r in rows}
    assert sorted(r for r in map(tuple, got.collect()) if r[0] in kept) == sorted(rows)
    assert sum(r[1] for r in rows) > 10


def test_odd_rows(spark):
    docs = odd(spark, 2000)
    more = [
        (9, " tail\tof \x0bit ok ok ok ok\nok ok ok ok ok ok ok ok\r", None, None, None),
        (None, "na na na na na na na na na na na na na na na na na", None, None, None),
        (38, "a b c d e f g h i j k l m n o p q r s t u v w x y z", None, None, None),
    ]
    extra = spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long")
    both = docs.unionByName(extra, allowMissingColumns=True)
    got = periodic_runs.digests(periodic_runs.find_runs(periodic_runs.with_repeats(both)))
    expected = [plain_row(r.doc_id, r.text) for r in both.collect()]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))
    none = no_rows(spark)
    assert periodic_runs.digests(periodic_runs.find_runs(periodic_runs.with_repeats(none))).collect() == []


def test_collapsed_texts(spark):
    docs = spark.createDataFrame([(1, "x  " + "la di da " * 6 + "end")], "doc_id long, text string")
    row = periodic_runs.find_runs(docs).first()
    assert row.collapsed == "x la di da end" and [tuple(r) for r in row.runs] == [(1, 18, 3)]
