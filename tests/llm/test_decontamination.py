"""Benchmark items in documents, against planted and searched ones."""

import numpy as np
import pytest
from rows import no_rows, odd

from lanehouse.llm import decontamination, svd
from lanehouse.llm.queries import QUERIES

ITEMS = "item_id long, text string"


def test_every_item_that_is_there_word_for_word(spark):
    folder = "/root/testdata/sf0.1"
    found = {(r.doc_id, r.item_id) for r in QUERIES["op9_decontamination"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    # the first and last letter may be changed by what stands around
    there = {(d.doc_id, b.item_id) for b in items for d in docs if b.text.strip(" .")[2:] in d.text}
    assert len(there) > 100 and there <= found
    assert len(found - there) <= 0.02 * len(there)


def language(rng, size):
    common = [f"w{k}" for k in range(40)]
    words = common * 12 + [f"rare{k}" for k in range(3000)]
    return [words[k] for k in rng.integers(0, len(words), size)]


@pytest.fixture(scope="module")
def planted(spark):
    """Documents of which some have an item, word for word or with some of its words replaced."""
    rng = np.random.default_rng(4)
    items = [language(rng, int(rng.integers(12, 60))) for _ in range(30)]
    docs, truth = [], set()
    for k in range(240):
        words = language(rng, int(rng.integers(20, 400)))
        if k < 120:
            own = list(items[k % 30])
            changed = rng.choice(len(own), int(len(own) * (0.0, 0.1, 0.2, 0.25)[k // 30]), replace=False)
            for place in changed:
                own[place] = f"new{k}x{place}"
            at = int(rng.integers(0, len(words)))
            words[at:at] = own
            truth.add((k, k % 30))
        docs.append((k, " ".join(words).capitalize()))
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([(k, " ".join(w[:-5]) + ". " + " ".join(w[-5:])) for k, w in enumerate(items)], ITEMS),
        truth,
    )


def test_paraphrases_are_found_and_clean_documents_left(planted):
    docs, items, truth = planted
    found = {(r.doc_id, r.item_id): r for r in decontamination.find_leaks(docs, items).collect()}
    assert set(found) <= truth
    exact = {key for key in truth if key[0] < 30}
    assert exact <= set(found) and all(found[key].common == 1 for key in exact)
    assert len(found) >= 0.9 * len(truth)
    kept = {r.doc_id for r in decontamination.without_leaks(docs, items).collect()}
    assert kept == set(range(240)) - {d for d, _ in found}


def test_blocks_of_items_find_the_same(planted, monkeypatch):
    docs, items, _ = planted
    whole = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, items).collect()}
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 2500)
    parts = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, items).collect()}
    assert len(whole ^ parts) <= 0.05 * len(whole)


def test_candidates_are_near_enough_by_brute_force(planted):
    docs, items, _ = planted
    (block,) = decontamination.blocks(docs, items)
    texts = [r.text for r in docs.limit(60).collect()]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    word, owner = decontamination.words(data, np.cumsum([0, *map(len, texts)]))
    count = np.bincount(owner, minlength=len(texts))
    got = {(s, i): c for s, _, _, i, c in decontamination.candidates(block, word, count)}
    place = decontamination.look_up(block.vocabulary, word)
    expected = {}
    for start, end, _ in zip(*decontamination.windows(count, block.window), strict=True):
        own = [p for p in place[start:end] if p >= 0]
        inside = sum(block.weights[p] ** 2 for p in own)
        whole = inside + block.other**2 * (end - start - len(own))
        if inside < decontamination.LEAST_SHARE * whole:
            continue
        vector = sum(block.latent[p] for p in own)
        cosines = block.passages @ vector / np.linalg.norm(vector)
        for i in np.unique(block.passage_item):
            best = cosines[block.passage_item == i].max()
            if best >= decontamination.LEAST_COSINE:
                expected[start, i] = best
    assert set(got) == set(expected) and got
    assert all(got[k] == pytest.approx(expected[k], abs=1e-4) for k in got)


def test_items_in_a_third_of_the_documents_are_found_at_every_alignment(spark):
    hot = " ".join(f"hot{k}" for k in range(15))
    others = [" ".join(f"seldom{i}x{k}" for k in range(40)) for i in range(20)]
    docs = []
    for k in range(240):
        around = [f"around{k}x{j}" for j in range(60)]
        if k % 3 == 0:
            around[k // 3 % 8 : k // 3 % 8] = [hot]
        docs.append((k, " ".join(around)))
    items = spark.createDataFrame(list(enumerate([hot, *others])), ITEMS)
    found = decontamination.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(k, 0) for k in range(0, 240, 3)}


def test_verbatim_items_of_every_length_are_found_at_every_alignment(spark):
    # all words are words of the benchmark, so what stands around an item is as near to others
    sizes = [*range(3, 24), 40, 200]
    own = {n: [f"own{n}x{k}" for k in range(n)] for n in sizes}
    every = [w for n in sizes for w in own[n]]
    rng = np.random.default_rng(13)
    docs, truth = [], set()
    for i, n in enumerate(sizes):
        for shift in range(16):
            around = [every[k] for k in rng.integers(0, len(every), 40)]
            around[shift:shift] = own[n]
            docs.append((len(docs), " ".join(around)))
            truth.add((len(docs) - 1, i))
    items = spark.createDataFrame([(i, " ".join(own[n])) for i, n in enumerate(sizes)], ITEMS)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontamination.find_leaks(table, items).collect()}
    assert truth <= set(found) and all(found[key].common == 1 for key in truth)
    assert all(found[d, i].word == d % 16 for d, i in truth)
    assert decontamination.without_leaks(table, items).count() == 0


def test_items_in_scripts_without_spaces_and_of_two_words(spark):
    items = ["北京是中国的首都，人口超过二千万。它的历史很长。", "東京は日本の首都です。", "กรุงเทพมหานครเป็นเมืองหลวง", "blue whale", "¿año—día?"]
    around = ["他说：%s对吗", "次の文、%s と書いた", "คำถาม%sครับ", "a Blue, whale swims", "un «año» (día) más"]
    docs = [a % i if "%s" in a else a for a, i in zip(around, items, strict=True)] + ["blue sky, grey whale", "北京的人口"]
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = decontamination.find_leaks(table, spark.createDataFrame(list(enumerate(items)), ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(k, k) for k in range(5)}


def test_words_are_those_of_a_plain_split():
    texts = ["Año nuevo, día—uno", "漢字 かな交じり文。", "", "x", "naïve\u0301 été…ÉTÉ 😀😀z", "ไทย abc漢def", "漢", "é"]
    data = [t.encode() for t in texts]
    got = decontamination.words(np.frombuffer(b"".join(data), dtype=np.uint8), np.cumsum([0, *map(len, data)]))
    parts = [["Año", "nuevo", "día", "uno"], [*"漢字かな交じり文"], [], ["x"], ["naïve\u0301", "été", "ÉTÉ", "z"],
             [*"ไทย", "abc", "漢", "def"], ["漢"], ["é"]]
    assert got[1].tolist() == [k for k, own in enumerate(parts) for _ in own]
    alone = [int(decontamination.words_of_text(w)[0]) for own in parts for w in own]
    assert got[0].tolist() == alone


def test_singular_values_and_vectors(spark):
    rng = np.random.default_rng(8)
    matrix = rng.standard_normal((90, 12)) * 0.7 ** np.arange(12) @ rng.standard_normal((12, 70))
    rows = [(np.flatnonzero(r).tolist(), r[r != 0].tolist()) for r in matrix] + [([], [])]
    table = spark.createDataFrame(rows, "columns array<long>, weights array<double>").repartition(5)
    values, vectors = svd.right_vectors(table, 70, 5)
    exact = np.linalg.svd(matrix)
    assert values == pytest.approx(exact.S[:5], rel=1e-3)
    assert abs(np.diag(vectors.T @ exact.Vh[:5].T)) == pytest.approx(np.ones(5), abs=1e-2)
    flat = spark.createDataFrame([([0, 1], [1.0, 1.0])] * 3, "columns array<long>, weights array<double>")
    assert svd.right_vectors(flat, 4, 3)[0] == pytest.approx([np.sqrt(6)])


def test_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (rng.integers(0, 5, rng.integers(0, 30)).tolist() for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontamination.common_subsequence(a, b) == table[-1, -1]


def test_bound_of_common_subsequences():
    rng = np.random.default_rng(2)
    vocabulary = np.sort(rng.integers(0, 2**63, 900).astype(np.uint64))
    own = [rng.choice(vocabulary[: 20 + 9 * k], k).tolist() for k in (1, 7, 12, 63, 64, 65, 90, 127, 128, 200)]
    empty = np.zeros((0, 1), dtype=np.float32)
    items = decontamination.Items(16, list(range(10)), own, [], [], vocabulary, empty, 0.0, empty, empty, empty)
    word = rng.choice(vocabulary[:300], 4000)
    item, low = rng.integers(0, 10, 500), rng.integers(0, 3800, 500)
    high = low + rng.integers(0, 200, 500)
    bucket = decontamination.look_up(vocabulary, word) % decontamination.BUCKETS
    bound = decontamination.most_common(items, bucket, low, high, item)
    for b, i, x, y in zip(bound, item, low, high, strict=True):
        exact = decontamination.common_subsequence(own[i], word[x:y].tolist())
        assert exact <= b <= len(own[i])


def test_odd_rows(spark):
    docs = odd(spark)
    items = spark.createDataFrame(
        [(1, "Another line of words there."), (1, "Another line of words there."), (2, None), (3, ""), (4, " \n. words"),
         (None, "漢字 \U0001f600\U0001f600 naïve"), (5, "no such words in any text at all here")],
        ITEMS,
    )
    found = decontamination.find_leaks(docs, items).collect()
    pairs = sorted(((r.doc_id, r.item_id) for r in found), key=repr)
    # the two equal rows, the one in capitals and the one without id; each item is there twice
    plain = [(1, 1)] * 4 + [(2**62, 1)] * 2 + [(None, 1)] * 2 + [(7, None)]
    assert pairs == sorted(plain, key=repr)
    kept = decontamination.without_leaks(docs, items)
    assert kept.columns == docs.columns and kept.count() == 12 - 5
    assert decontamination.find_leaks(no_rows(spark), items).collect() == []
    assert decontamination.find_leaks(docs, items.limit(0)).collect() == []
    assert decontamination.without_leaks(docs, items.limit(0)).count() == 12
