"""Near-duplicates against comparison of all pairs."""

from collections import Counter

import numpy as np
import pytest
from rows import DOCUMENTS, no_rows, odd

from lanehouse.llm import near_dedup
from lanehouse.llm.graphs import components
from lanehouse.llm.queries import QUERIES


def shingles(text):
    words = (text or "").split()
    if not words:
        return Counter()
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def jaccard(a, b):
    every = a | b
    return sum((a & b).values()) / sum(every.values()) if every else 0.0


def classes(rows, weighted=False):
    """The class of each (id, text): by single linkage over all pairs."""
    sets = [shingles(t) if weighted else Counter(dict.fromkeys(shingles(t), 1)) for _, t in rows]
    label = list(range(len(rows)))

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    holders: dict = {}
    for k, found in enumerate(sets):
        for s in found:
            holders.setdefault(s, []).append(k)
    shared: Counter = Counter()
    for k, found in enumerate(sets):
        near = {j for s in found for j in holders[s] if j < k}
        for j in near:
            if jaccard(found, sets[j]) >= 0.8:
                label[max(top(j), top(k))] = min(top(j), top(k))
    by_text: dict = {}
    for k, (_, text) in enumerate(rows):
        j = by_text.setdefault(text or "", k)
        label[max(top(j), top(k))] = min(top(j), top(k))
    least: dict = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(top(k), []).extend([i] if i is not None else [])
    assert not shared
    return sorted(((i, min(least[top(k)], default=None)) for k, (i, _) in enumerate(rows)), key=repr)


def found(df):
    return sorted(((r.doc_id, r.class_id) for r in df.collect()), key=repr)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_classes_of_documents(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    expected = classes(rows)
    assert found(QUERIES["op2_near_dedup"](spark, folder)) == expected
    assert len({c for _, c in expected}) < len(rows)


def family(size, words=150, seed=1):
    """Texts that each differ from one base in some words, so that many pairs lie about the bound."""
    rng = np.random.default_rng(seed)
    base = [f"base{k}" for k in range(words)]
    rows = []
    for k in range(size):
        own = list(base)
        for place in rng.choice(words, rng.integers(0, 7), replace=False):
            own[place] = f"own{k}x{place}"
        rows.append((k, " ".join(own)))
    return rows


@pytest.mark.parametrize("block", [1000, 20])
def test_a_family_about_the_bound(spark, block):
    rows = family(300) + [(1000 + k, " ".join(f"other{k}x{j}" for j in range(60))) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_dedup.near_duplicates(docs, block=block)) == classes(rows)


def test_repeated_shingles_weigh_with_their_number(spark):
    line = " ".join(f"w{k}" for k in range(40)) + " "
    rows = [(1, line * 2), (2, line * 10), (3, line * 9), (4, line + "x " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for weighted in (False, True):
        assert found(near_dedup.near_duplicates(docs, weighted=weighted)) == classes(rows, weighted)
    assert classes(rows) != classes(rows, weighted=True)


def test_agreement_of_signatures_is_weighted_similarity():
    rng = np.random.default_rng(2)
    left = dict(zip(range(60), rng.random(60) * 5, strict=True))
    right = {k: w * rng.random() * 1.5 for k, w in left.items() if k % 3} | {100 + k: 2.5 for k in range(10)}
    similarity = sum(min(left.get(k, 0), right.get(k, 0)) for k in left | right) / sum(
        max(left.get(k, 0), right.get(k, 0)) for k in left | right
    )
    agree = []
    for salt in range(40):
        element = np.array([hash((k, salt)) & (2**63 - 1) for d in (left, right) for k in d], dtype=np.uint64)
        weight = np.array([w for d in (left, right) for w in d.values()])
        owner = np.repeat([0, 1], [len(left), len(right)])
        rows = near_dedup.signatures(element, weight, owner, 2, 128)
        assert rows.all()
        agree.append((rows[0] == rows[1]).mean())
        alone = near_dedup.signatures(element[: len(left)], weight[: len(left)], owner[: len(left)], 1, 128)
        assert np.array_equal(alone[0], rows[0])
    assert abs(np.mean(agree) - similarity) < 0.03


def test_first_of_class_keeps_one_of_each(spark):
    docs = odd(spark)
    kept = near_dedup.first_of_class(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(near_dedup.near_duplicates(docs)) == classes(rows)
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert len(got) == 8 and len([r for r in got if not r[1]]) == 1
    assert near_dedup.first_of_class(no_rows(spark)).collect() == []
    assert near_dedup.near_duplicates(no_rows(spark)).collect() == []
    nameless = spark.createDataFrame([(None, "a b c d e f", None, None, 1)] * 3, DOCUMENTS)
    assert near_dedup.first_of_class(nameless).count() == 1
    assert {r.class_id for r in near_dedup.near_duplicates(nameless).collect()} == {None}


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101 + k) for k in range(50)] + [(7, 7), (200, 199), (300, 300)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = dict.fromkeys(range(41), 0) | dict.fromkeys(range(100, 151), 100) | {199: 199, 200: 199}
    assert got == expected
