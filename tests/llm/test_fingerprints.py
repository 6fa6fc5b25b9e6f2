"""Fingerprints against plain sets of paragraphs."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F
from rows import no_rows, odd

from lanehouse.llm import fingerprints
from lanehouse.llm.queries import QUERIES


def paragraphs(text):
    return {p.strip(" ") for p in re.split(r"\n|(?<=[.!?]) ", text)} - {""}


def likeness(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(text, following):
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def expected(texts):
    for k, text in enumerate(texts):
        following = texts[(k + 1) % len(texts)]
        change = edited(text, following)
        yield (
            len(text),
            hashlib.sha256(change.encode()).hexdigest(),
            likeness(text, change),
            likeness(text, following),
            len(paragraphs(text) - paragraphs(change)),
            len(paragraphs(change) - paragraphs(text)),
        )


def test_documents(spark, sf_dir):
    got = QUERIES["op1_fingerprints"](spark, sf_dir).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [d.doc_id for d in docs]
    for r, e in zip(got, expected([d.text for d in docs]), strict=True):
        assert (r.n_chars, r.edited_sha256) == e[:2]
        assert (r.near_edited, r.near_next) == pytest.approx(e[2:4])
        assert (r.n_removed, r.n_added) == e[4:]
    prints: dict = {}
    for r, d in zip(got, docs, strict=True):
        assert prints.setdefault(d.text, r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len({frozenset(paragraphs(t)) for t in prints})


def test_neighbours_over_many_buckets(spark):
    ids = [k * k for k in range(400)] + [10**18, -5, 7, 7]
    docs = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate(ids)], "doc_id long, text string")
    got = {(r.doc_id, r.text): r.next_text for r in fingerprints.with_next(docs.repartition(7)).collect()}
    assert len(got) == len(ids)
    order = sorted(range(len(ids)), key=lambda k: ids[k])
    follow = {f"text {a}": f"text {b}" for a, b in zip(order, [*order[1:], order[0]], strict=True)}
    for (i, text), after in got.items():
        if i != 7 and after not in {f"text {k}" for k, v in enumerate(ids) if v == 7}:
            assert after == follow[text]
    # the two rows of one id stand together, in either order
    start, seen = "text 399", []
    by_text = {text: after for (_, text), after in got.items()}
    while start not in seen:
        seen.append(start)
        start = by_text[start]
    assert len(seen) == len(ids)


def test_rows_of_one_id_are_split(spark):
    bounds = fingerprints.bucket_bounds([5, 7, 7, 7, 7, 9], 3)
    assert [i for i, _ in bounds] == [None, None, 5, 7, 7, 7, 7, 9]
    assert bounds[3] == (7, -(1 << 63)) and bounds[5] == (7, 0) and bounds == sorted(bounds, key=lambda b: (b[0] or 0, b[1]))
    rows = [(None, f"none {k}") for k in range(300)] + [(7, f"seven {k}") for k in range(300)]
    rows += [(k, f"text {k}") for k in range(1000, 1300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.text): (r.next_text, r.at) for r in fingerprints.with_next(docs).withColumn("at", F.spark_partition_id()).collect()}
    assert len(got) == len(rows)
    # every row has one after it, in one round through all of them, and an id's rows stand together
    follow, start, seen = {text: after for (_, text), (after, _) in got.items()}, "text 1299", []
    while start not in seen:
        seen.append(start)
        start = follow[start]
    kinds = [text.split()[0] for text in seen]
    assert len(seen) == len(rows) and [k for k, before in zip(kinds, ["", *kinds], strict=False) if k != before] == [
        "text", "none", "seven", "text",
    ]


def test_odd_rows(spark):
    got = fingerprints.fingerprints(odd(spark)).collect()
    assert len(got) == 12
    empty = [r for r in got if r.n_chars == 0]
    assert sorted(((r.doc_id, r.near_edited) for r in empty), key=repr) == [(2, 1.0), (3, 1.0), (None, 1.0)]
    twice = [r for r in got if r.doc_id == 1]
    assert len(twice) == 3 and len({r.fingerprint for r in twice}) == 2
    assert fingerprints.fingerprints(no_rows(spark)).collect() == []
    (one,) = fingerprints.fingerprints(odd(spark).limit(1)).collect()
    assert one.near_next == 1.0


@pytest.mark.parametrize("shared, only_left, only_right", [(0, 0, 0), (50, 3, 0), (9, 40, 60), (0, 700, 900)])
def test_differences_are_recovered(spark, shared, only_left, only_right):
    sets = spark.range(5).select(
        *(
            F.transform(F.sequence(F.lit(0), F.lit(n + shared)), lambda i: F.xxhash64(i, "id", F.when(i > shared, side)))
            .alias(name)
            for name, n, side in (("a", only_left, F.lit(1)), ("b", only_right, F.lit(2)))
        )
    )
    cells = sets.withColumns({"ca": fingerprints.sketch(F.col("a")), "cb": fingerprints.sketch(F.col("b"))})
    found = cells.select(
        "a", "b", fingerprints.differences(*(F.col(c) for c in ("a", "b", "ca", "cb"))).alias("d")
    )
    for r in found.collect():
        assert {x.k for x in r.d if x.n == 1} == set(r.a) - set(r.b)
        assert {x.k for x in r.d if x.n == -1} == set(r.b) - set(r.a)
        assert len(r.d) == only_left + only_right


def test_small_differences_need_the_fingerprints_only(spark):
    sets = spark.range(200).select(
        F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.xxhash64(i, "id")).alias("a"),
        F.transform(F.sequence(F.lit(4), F.lit(103)), lambda i: F.xxhash64(i, "id")).alias("b"),
    )
    cells = fingerprints.subtract(fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b")))
    found = sets.select(cells.alias("c")).select(fingerprints.peel(F.col("c"), F.lit(24), 0).alias("d"))
    sizes = [None if r.d is None else len(r.d) for r in found.collect()]
    assert set(sizes) <= {8, None} and sizes.count(8) > 170


def test_only_spark_functions(spark, sf_dir):
    text = QUERIES["op1_fingerprints"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
    # one shuffle: of the texts to their neighbours
    assert text.count("Exchange hashpartitioning") == 1
