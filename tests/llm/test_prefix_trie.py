"""The trie of conversations against one made of dictionaries."""

import hashlib
import zlib

import numpy as np
import pytest

from lanehouse.llm import prefix_trie
from lanehouse.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string, key string, path string, shard string"


def plain_sequences(rows):
    """(role, text) in order by conversation; equal turn numbers by the digest, as the operator has them."""
    found = {}
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            found.setdefault(conv_id, []).append((turn is not None, turn or 0, key, (role, text)))
    return {c: [t[-1] for t in sorted(turns)] for c, turns in found.items()}


def plain_branched(found):
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in found}
    return {c: found.get(c - c % 5, [])[: h[c]] + turns[h[c] :] for c, turns in found.items()}


def plain_trie(found):
    members = {}
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved, rows = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[b] for b in below) or 1
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        saved[path] = own + sum(saved[b] for b in below)
        ends = ",".join(map(str, sorted(c for c in members[path] if len(found[c]) == len(path))))
        rows.append(
            (
                min(members[path]), len(path), min(members[path[:-1]]) if path else None, len(members[path]),
                len(below), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(rows, key=repr)


def got(df):
    assert tuple(df.columns) == prefix_trie.RESULT
    return sorted(map(tuple, df.collect()), key=repr)


def test_conversations(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    trie = QUERIES["op12_prefix_trie"](spark, sf_dir)
    assert got(trie) == plain_trie(plain_branched(plain_sequences(map(tuple, rows))))


def made(seed, count):
    """Conversations with few different turns, many of them copies, some without an early turn."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(count):
        length = int(rng.integers(1, 7)) if c % 3 else 4
        for turn in range(length):
            text = f"t{turn}" if c % 3 == 0 else "x" * int(rng.integers(0, 3))
            rows.append((7 * c - 100, turn if turn else None, "user" if turn % 2 else None, text))
    return rows


@pytest.mark.parametrize("shards, held", [(1, 2), (7, 2), (7, 10_000), (60, 10_000)])
def test_any_shards_give_the_same(spark, shards, held):
    # a third are copies of one conversation, so several splitters are copies too
    rows = made(shards, 150)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found = prefix_trie.sequences(df)
    assert got(prefix_trie.prefix_trie(found, shards, held)) == plain_trie(plain_sequences(rows))


def test_lists_in_parts(monkeypatch):
    monkeypatch.setattr(prefix_trie, "PART_IDS", 3)
    path, rows = bytes(range(16)), []
    for cuts in ([], [(path, 4)]):
        shards = [prefix_trie.Shard(k, cuts, rows, 10) for k in range(len(cuts) + 1)]
        for c in range(8):
            shards[sum((path, c) >= cut for cut in cuts)].add(path, c, [5])
        for shard in shards:
            shard.end()
    whole = hashlib.sha256(b"0,1,2,3,4,5,6,7").hexdigest()
    assert [r[10] for r in rows if r[0] == prefix_trie.NODE and r[4] == 1] == [whole]
    parts = [(r[11], r[12], r[10]) for r in rows if r[0] == prefix_trie.MEMBERS]
    assert sorted(parts) == [(0, 0, "0,1,2"), (0, 1, "3"), (1, 0, "4,5,6"), (1, 1, "7")]


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "hi", "k", "p", "s"),
        (1, None, None, None, None, None, None),
        (1, 0, "user", "hi", "k", "p", "s"),
        (1, 0, "assistant", "hi", "k", "p", "s"),
        (None, 0, "user", "lost", None, None, None),
        (5, None, None, None, None, None, None),
        (6, 3, "user", "z" * 100_000, "k", "p", "s"),
        (-4, 1, "", "é\U0001f600", "k", "p", "s"),
        (2**62, 1, None, "é\U0001f600", "k", "p", "s"),
        *((8, t, "user", f"turn {t % 3}", None, None, None) for t in range(3000)),
        *((9, t, "user", f"turn {t % 3}", None, None, None) for t in range(2990)),
    ]
    found = prefix_trie.sequences(spark.createDataFrame(rows, TURNS))
    plain = plain_sequences(rows)
    assert got(prefix_trie.prefix_trie(found)) == plain_trie(plain)
    del plain[-4]
    kept = prefix_trie.branched(found.where("conv_id >= 0"))
    assert got(prefix_trie.prefix_trie(kept)) == plain_trie(plain_branched(plain))


def test_no_conversations(spark):
    none = prefix_trie.sequences(spark.createDataFrame([], TURNS))
    assert got(prefix_trie.prefix_trie(prefix_trie.branched(none))) == []
