"""Files of token ids: coding by a plain reader, ids by the tokenizer on whole texts, round trips."""

import unicodedata
import zlib

import numpy as np
import pytest
from pyarrow import fs
from rows import no_rows, odd

from lanehouse.llm import id_files
from lanehouse.llm.queries import QUERIES, tokenizer

JSON = tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(JSON)
    return lambda text: [*tokens.encode(text or "", add_special_tokens=False).ids, 1]


def plain_numbers(control, data, counts):
    """Number by number, as the format says."""
    out, at, byte = [], 0, 0
    for count in counts:
        for k in range(count):
            size = (int(control[byte + k // 4]) >> 2 * (k % 4) & 3) + 1
            out.append(int.from_bytes(bytes(data[at : at + size]), "little"))
            at += size
        byte += -(-count // 4)
    assert at == len(data) and byte == len(control)
    return out


def test_coding_of_numbers():
    rng = np.random.default_rng(0)
    for top in (2, 250, 300, 70_000, 1 << 25, 1 << 32):
        counts = rng.integers(0, 11, 50)
        numbers = rng.integers(0, top, counts.sum(), dtype=np.uint64).astype(np.uint32)
        control, data, bounds = id_files.encoded(numbers, counts)
        assert plain_numbers(control, data, counts) == numbers.tolist()
        assert id_files.decoded(control, data, counts).tolist() == numbers.tolist()
        # a document by itself, from where its bytes begin
        begins = np.concatenate([[0], np.cumsum(-(-counts // 4))])
        for k in (0, 7, 49):
            own = id_files.decoded(
                control[begins[k] : begins[k + 1]], data[bounds[k] : bounds[k + 1]], counts[k : k + 1]
            )
            assert own.tolist() == numbers[counts[:k].sum() : counts[: k + 1].sum()].tolist()
    edges = np.array([0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24, (1 << 32) - 1], dtype=np.uint32)
    control, data, _ = id_files.encoded(edges, np.array([8]))
    assert len(data) == 1 + 1 + 2 + 2 + 3 + 3 + 4 + 4
    assert id_files.decoded(control, data, np.array([8])).tolist() == edges.tolist()


def test_a_file_is_whole_or_refused():
    content = id_files.file_bytes([None, 5, 5], np.array([2, 1, 4]), np.array([3, 300, 0, 1, 2, 70_000, 4]))
    doc_ids, counts, numbers = id_files.read_bytes(content)
    assert (doc_ids, counts.tolist(), numbers.tolist()) == ([None, 5, 5], [2, 1, 4], [3, 300, 0, 1, 2, 70_000, 4])
    for bad in (content[:-1], b"x" + content[1:], content + b"x"):
        with pytest.raises(ValueError):
            id_files.read_bytes(bad)


def test_ids_word_by_word_are_those_of_whole_texts(plain):
    import pyarrow as pa

    words = id_files.Words(JSON)
    points = [c for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Co", "Cs")]
    points = [c for c in points if not 0x4E00 <= c < 0xD7A4 or c % 50 == 0]
    found = [
        "".join(f"a{chr(c)}a 1{chr(c)}1 ,{chr(c)},  {chr(c)} X\t{chr(c)}'s\n" for c in points[k : k + 400])
        for k in range(0, len(points), 400)
    ]
    found += ["", " ", "<|endoftext|>x <|startoftext|> <|endof text|>", "I'M she'll\x0bCAFÉ ́e", "q" * 50_000]
    rng = np.random.default_rng(0)
    letters = [*map(chr, range(32, 127)), *"\n\t'sSTt'|<>ÀéßÿŸµªºİΣσÅ\u030a\u0301"]
    found += ["".join(rng.choice(letters, 300)) for _ in range(300)]
    ids, counts = words.ids(pa.array(found), 1)
    own = np.split(ids, np.cumsum(counts)[:-1])
    for text, part in zip(found, own, strict=True):
        assert part.tolist() == plain(text)


def test_what_is_kept_has_a_bound(plain, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(id_files, "KEPT_WORDS", 20)
    monkeypatch.setattr(id_files, "KEPT_PIECES", 30)
    words, most = id_files.Words(JSON), 0
    for k in range(30):
        texts = [f"word{k} other,word {n} x{n * k}y" for n in range(5)]
        ids, counts = words.ids(pa.array(texts), 1)
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [plain(t) for t in texts]
        most = max(most, len(words.words), len(words.pieces))
    assert most < 80


def test_plain_words_are_cut_together_and_only_their_pieces_are_kept(plain, monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(1)
    letters = [*"''sstmdrevll", *"aZ09.-}~éÀß"]
    cut = ["".join(rng.choice(letters, rng.integers(1, 9))) for _ in range(20_000)]
    cut += ["'", "'r", "x'", "'s't", "''s"]
    lower = [w.lower() for w in cut]
    pieces, bounds = id_files.cut_words(pa.array(lower).slice(3))
    pieces = pieces.to_pylist()
    own = [pieces[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert own == [id_files.PIECES.findall(w) for w in lower[3:]]
    none, ends = id_files.cut_words(pa.array([], pa.string()))
    assert (len(none), ends.tolist()) == (0, [0])

    words, met = id_files.Words(JSON), []
    learn = words.pieces.learn
    monkeypatch.setattr(words.pieces, "learn", lambda new: [met.extend(new), learn(new)][1])
    held = len(words.words)
    for k in range(0, len(cut), 1000):
        texts = [" ".join(cut[k : k + 1000]), " ".join(reversed(cut[: k + 500]))]
        ids, counts = words.ids(pa.array(texts), 1)
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [plain(t) for t in texts]
    assert len(met) == len(set(met)) and len(words.words) == held == 0


def test_a_piece_that_the_tokenizer_leaves_out_is_no_silent_shift():
    table = id_files.Table(lambda new: (np.zeros(1, dtype=np.uint32), np.ones(1)))
    with pytest.raises(ValueError):
        table.rows(["a", "b"])
    assert (len(table), table.row) == (0, {})


def test_packed_parts_are_those_of_each_document():
    from lanehouse.llm.frames import packed, unpacked

    numbers = np.array([0, 255, 256, 70_000, (1 << 32) - 1, 1, 1], dtype=np.uint32)
    parts = id_files.packed_parts(numbers, np.array([0, 2, 2, 7]))
    assert parts == [packed(numbers[:2]), packed(numbers[:0]), packed(numbers[2:])]
    assert [unpacked(p).tolist() for p in parts] == [[0, 255], [], numbers[2:].tolist()]


def test_a_tokenizer_that_keeps_white_space_is_refused():
    with pytest.raises(ValueError):
        id_files.Words(tokenizer("byte_bpe_50k.json"))


def expected(rows, plain):
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array(plain(text), dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_documents(spark, sf_dir, plain):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = QUERIES["op13_id_files"](spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == expected([(d.doc_id, d.text) for d in docs], plain)


def test_odd_rows_over_many_files(spark, plain, tmp_path):
    docs = odd(spark)
    files = id_files.write_ids(docs.repartition(3), JSON, str(tmp_path), 1, file_ids=10)
    assert files.count() > 3
    got = id_files.read_ids(files, str(tmp_path)).orderBy("start").collect()
    rows = docs.collect()
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in rows), key=lambda i: (i is not None, i))
    texts = sorted((repr(r.doc_id), plain(r.text)) for r in rows)
    assert sorted((repr(r.doc_id), np.frombuffer(r.ids, dtype="<u4").tolist()) for r in got) == texts
    place = 0
    for r in got:
        assert (r.start, 4 * r.n_tokens) == (place, len(r.ids))
        place += r.n_tokens
    # nothing half written stays, and frequent ids come first
    names = [f.base_name for f in fs.LocalFileSystem().get_file_info(fs.FileSelector(str(tmp_path)))]
    assert sorted(names) == sorted([id_files.RANKS, *(r.file.rpartition("/")[2] for r in files.collect())])
    ranks = np.frombuffer((tmp_path / id_files.RANKS).read_bytes(), dtype="<u4", offset=8)
    counts = np.bincount([i for r in rows for i in plain(r.text)])
    assert ranks.tolist() == sorted(np.flatnonzero(counts).tolist(), key=lambda i: (-counts[i], i))


def test_no_documents(spark, tmp_path):
    files = id_files.write_ids(no_rows(spark), JSON, str(tmp_path), 1)
    assert files.count() == 0 and id_files.read_ids(files, str(tmp_path)).collect() == []
