"""Token counts and packing against the tokenizer itself and plain packing."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lanehouse.llm import packing, token_counts
from lanehouse.llm.queries import QUERIES, tokenizer

JSON, RANKS = tokenizer("byte_bpe_50k.json"), tokenizer("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, uid string, part int, answer string, sequence_id long"
ROWS = [
    (1, "a plain text, with 12 numbers!  \n\n and space   ", "x", 1, "y", 5),
    (2, None, None, None, None, None),
    (2, "", "x", 1, "y", 5),
    (None, "<|endoftext|> in <|endoftext|><|endoftext|>\n", "x", 1, "y", 5),
    (4, "don't we'll I'M  x \x1c\x85 ՘ \U0001fae8 été ǅ ٣٤ ½", "x", 1, "y", 5),
    (4, "don't we'll I'M  x \x1c\x85 ՘ \U0001fae8 été ǅ ٣٤ ½", "x", 1, "y", 5),
    (6, "word " * 30_000, "x", 1, "y", 5),
    (7, "q" * 50_000, "x", 1, "y", 5),
]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(JSON)
    return lambda text: tokens.encode(text or "", add_special_tokens=False).ids


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_counts_of_odd_texts(spark, plain):
    got = token_counts.token_counts(spark.createDataFrame(ROWS, SCHEMA), JSON, 100)
    expected = [
        (i, len((t or "").encode()), len(plain(t)), len(plain(t)) > 100) for i, t, *_ in ROWS
    ]
    assert rows(got) == sorted(expected, key=repr)


def test_counts_of_documents(spark, sf_dir, plain):
    got = QUERIES["op10_token_counts"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    expected = [
        (d.doc_id, len(d.text.encode()), len(plain(d.text)), len(plain(d.text)) > 1024) for d in docs
    ]
    assert rows(got) == sorted(expected, key=repr)


def test_counts_over_many_buckets(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one = rows(token_counts.token_counts(docs, JSON))
    monkeypatch.setattr(token_counts, "BUCKET_WORDS", 50)
    monkeypatch.setattr(token_counts, "CHUNK_BYTES", 20_000)
    assert rows(token_counts.token_counts(docs, JSON)) == one


def test_no_documents(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert token_counts.token_counts(none, JSON).collect() == []
    assert packing.pack_documents(none, JSON).collect() == []


def test_both_libraries_give_the_same_ids(plain):
    # one text for every character there is, in the neighbourhoods that the pattern tells apart
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for first in range(0, len(points), 400):
        text = "".join(f"a{chr(c)}a 1{chr(c)}1 ,{chr(c)},  {chr(c)} x" for c in points[first : first + 400])
        assert packing.token_ids(text, JSON, RANKS).tolist() == plain(text)


LONG = {
    "spaces": " " * 2_000_000 + "x", "feeds": "\n" * 2_000_000 + "x", "letters": "z" * 2_000_000,
    "mixed": "a \t" + "\r" * 1_200_000 + "<|endoftext|>\u3000" + "é" * 9,
}


@pytest.mark.parametrize("name", LONG)
def test_very_long_stretches(plain, name):
    assert packing.token_ids(LONG[name], JSON, RANKS).tolist() == plain(LONG[name])


def test_documents_with_very_long_stretches_are_packed(spark, plain):
    docs = list(enumerate([*LONG.values(), "short", None]))
    got = packing.pack_documents(spark.createDataFrame(docs, "doc_id long, text string"), JSON, ranks_path=RANKS)
    check_packing(got.collect(), docs, plain, 2048)


def check_packing(got, docs, plain, size):
    by_doc: dict = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in docs:
        ids = np.array([*plain(text), 0], dtype="<u4")
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.length for r in own[1:]] == [size] * (len(own) - 1)
        assert len(own) == -(-len(ids) // size)
        place = 0
        for r in own:
            assert r.start == place
            assert r.ids_crc32 == zlib.crc32(ids[place : place + r.length].tobytes())
            place += r.length
        assert place == len(ids)
    by_sequence: dict = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= size
    return len(by_sequence)


def test_packing_of_documents(spark, sf_dir, plain):
    got = QUERIES["op7_best_fit_packing"](spark, sf_dir).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    used = check_packing(got, docs, plain, 2048)
    assert used <= sum(r.length for r in got) / 2048 * 1.02 + 1


def test_packing_of_odd_texts_in_small_groups(spark, plain):
    distinct = [r for k, r in enumerate(ROWS) if k not in (2, 5)]
    docs = spark.createDataFrame(distinct, SCHEMA)
    got = packing.best_fit(packing.pieces(docs, JSON, 64, ranks_path=RANKS), 64, group=2).collect()
    check_packing(got, [r[:2] for r in distinct], plain, 64)
    twice = packing.pack_documents(spark.createDataFrame(ROWS, SCHEMA), JSON, 64)
    assert twice.count() == sum(-(-(len(plain(r[1])) + 1) // 64) for r in ROWS)
    assert twice.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 64").count() == 0


def test_sum_of_squares_follows_its_rule():
    rng = np.random.default_rng(5)
    for size in (10, 37):
        lengths = rng.integers(1, size + 1, 300)
        number, offset = packing.sum_of_squares(lengths, size)
        fill: dict[int, int] = {}
        for length, place, at in zip(lengths.tolist(), number.tolist(), offset.tolist(), strict=True):
            room = [k for k, v in fill.items() if v + length <= size]
            if not room:
                assert place not in fill and at == 0
            else:
                def squares(k, length=length):
                    gaps: dict[int, int] = {}
                    for other, used in fill.items():
                        gap = size - used - (length if other == k else 0)
                        gaps[gap] = gaps.get(gap, 0) + (gap > 0)
                    return sum(n * n for n in gaps.values()), size - fill[k]
                assert squares(place) == min(map(squares, room)) and at == fill[place]
            fill[place] = fill.get(place, 0) + length
