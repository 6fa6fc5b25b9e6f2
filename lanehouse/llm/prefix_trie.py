"""The trie of what conversations begin with, made in sorted shards around a skeleton.

A conversation is a path: 16 bytes of a digest per turn. Conversations are cut into ranges of (path, id) by
splitters, which are conversations themselves. A node that has members in two ranges begins the path of the
splitter between them. So the trie of all prefixes of splitter paths, the skeleton, is known beforehand and
small: it goes to all tasks. Every shard reads its range in order and has each node open from its first
member to its last; the nodes off the skeleton are finished there. Of the skeleton's nodes each shard gives
what it has seen, and these parts are summed: a node counts as a leaf and as a child in the shard where it
ends, so nothing is counted twice. Copies of one conversation are told apart by id and split like others.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lanehouse.llm.frames import keep

STEP = 16
#: shards at most, and conversations that make one more
MOST_SHARDS = 1024
SHARD_ROWS = 200_000
#: conversations looked at per splitter; the bytes of all their paths, and of one
SAMPLES = 16
SAMPLE_BYTES = 64 << 20
SPLITTER_BYTES = 64 << 10
#: ids that make a part of a list, and children that wait for their parent's id
PART_IDS = 10_000
HELD = 10_000

NODE, SHARE, MEMBERS = 0, 1, 2
NUMBERS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
PARTS = pa.schema(
    [
        ("kind", pa.int8()),
        ("key", pa.binary()),
        ("parent_key", pa.binary()),
        ("conv_id", pa.int64()),
        ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()),
        *((name, pa.int64()) for name in NUMBERS),
        ("ends", pa.string()),
        ("shard", pa.int32()),
        ("part", pa.int64()),
    ]
)
RESULT = ("conv_id", "depth", "parent_conv_id", *NUMBERS, "ends_sha256")


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and its ``turns`` in order: a digest of role and text, and the bytes of the text.

    NULL role or text is empty, a NULL turn comes first, turns of the same number stand by their digest, and
    a row without ``conv_id`` belongs to no conversation. A conversation is held as one value, 40 bytes a
    turn, as a text is; its texts aren't moved.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct(
        F.col("turn").isNotNull().alias("numbered"),
        F.col("turn").cast("long").alias("turn"),
        F.substring(digest, 1, 2 * STEP).alias("key"),
        F.octet_length(text).cast("long").alias("size"),
    )
    listed = conversations.where(F.col("conv_id").isNotNull()).groupBy(
        F.col("conv_id").cast("long").alias("conv_id")
    )
    in_order = F.array_sort(F.collect_list(turn))
    kept = F.transform(in_order, lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size")))
    return listed.agg(kept.alias("turns"))


def branched(rows: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """Sequences of which each begins like the first of its family of ids.

    Conversation c takes the first h turns of c - c % ``family``, all if it has fewer, none if there is no
    such conversation, and then its own after its first h; h is crc32 of the decimal c, modulo ``most``.
    """
    rows = keep(rows, "sequences")
    heads = rows.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("_first"), F.slice("turns", 1, most - 1).alias("_head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    own = rows.withColumns({"_first": F.col("conv_id") - F.col("conv_id") % family, "_h": h})
    head = F.coalesce(F.slice("_head", F.lit(1), F.col("_h")), F.slice("turns", 1, 0))
    tail = F.slice("turns", F.col("_h") + 1, F.size("turns"))
    return own.join(heads, "_first", "left").select("conv_id", F.concat(head, tail).alias("turns"))


def splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most ``shards - 1`` pairs of path and id, in order, that cut ``paths`` into ranges of equal work.

    They are taken from some conversations whose paths have ``SPLITTER_BYTES`` at most; all that comes to
    the driver, and later to the tasks, has ``SAMPLE_BYTES`` at most.
    """
    short = paths.where(F.length("path") <= SPLITTER_BYTES)
    longest = short.agg(F.max(F.length("path"))).first()[0] or 0
    wanted = min(SAMPLES * shards, SAMPLE_BYTES // (longest + STEP))
    taken = short.orderBy(F.xxhash64("conv_id"), "conv_id").limit(wanted).select("path", "conv_id").collect()
    rows = sorted((bytes(r.path), r.conv_id) for r in taken)
    work, found = 0, []
    share = sum(len(path) + STEP for path, _ in rows) / shards
    for row in rows:
        if work >= share * (len(found) + 1):
            found.append(row)
        work += len(row[0]) + STEP
    return found


def in_common(a: bytes, b: bytes) -> int:
    """Turns that both paths begin with."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size // STEP
    at = 0
    while a[at : at + STEP] == b[at : at + STEP]:
        at += STEP
    return at // STEP


def keys_along(path: bytes) -> list[bytes]:
    """A key for each node on the path, the root's first."""
    chain = hashlib.sha256()
    keys = [chain.digest()[:STEP]]
    for at in range(0, len(path), STEP):
        chain.update(path[at : at + STEP])
        keys.append(chain.copy().digest()[:STEP])
    return keys


class Node:
    """An open node of one shard; ``key`` is that of a skeleton node, ``name`` what its children know it by."""

    def __init__(self, size: int, key: bytes | None) -> None:
        self.size, self.key, self.name = size, key, key
        self.least: int | None = None
        self.count = self.children = self.leaves = self.saved = self.part = 0
        self.parted = False
        self.ids: list[int] = []
        self.digest = hashlib.sha256()
        self.held: list[list] = []


class Shard:
    """Reads one range in order; ``rows`` gets the nodes it finishes and its shares in skeleton nodes."""

    def __init__(self, number: int, cuts: list[tuple[bytes, int]], rows: list[list], held: int) -> None:
        self.number, self.rows, self.most_held = number, rows, held
        self.left = cuts[number - 1][0] if number else None
        self.right = cuts[number][0] if number < len(cuts) else None
        self.skeleton = [(path, keys_along(path)) for path in (self.left, self.right) if path is not None]
        self.path = b""
        self.open = [Node(0, self.skeleton[0][1][0] if self.skeleton else None)]

    def add(self, path: bytes, conv_id: int, sizes: list[int]) -> None:
        common, depth = in_common(path, self.path), len(path) // STEP
        self.close(common)
        if depth > common:
            self.list_ids(self.open[-1])
            keys = [None] * depth
            for other, own in self.skeleton:
                reach = in_common(path, other)
                keys[:reach] = own[1 : reach + 1]
            self.open += [Node(sizes[d], keys[d]) for d in range(common, depth)]
        self.path = path
        node = self.open[-1]
        node.count += 1
        node.least = conv_id if node.least is None else min(node.least, conv_id)
        node.ids.append(conv_id)
        if len(node.ids) >= PART_IDS:
            self.list_ids(node)

    def list_ids(self, node: Node) -> None:
        """Hand on the ids that end at a node: as text where other shards may have more of them."""
        if not node.ids:
            return
        text = ",".join(map(str, node.ids))
        if node.key is None:
            node.digest.update((text if node.part == 0 else f",{text}").encode())
        else:
            self.rows.append([MEMBERS, node.key, *[None] * 8, text, self.number, node.part])
        node.part += 1
        node.ids = []

    def close(self, depth: int, last: int = -1) -> None:
        """Close what is open below ``depth``; nodes down to the depth ``last`` go on in the next shard."""
        while len(self.open) > depth + 1:
            own = len(self.open) - 1
            node = self.open.pop()
            above = self.open[-1] if self.open else None
            self.list_ids(node)
            ended = own > last
            node.leaves += ended and not node.parted
            node.saved += (node.count - ended) * node.size
            numbers = [node.least, own, None, node.count, node.children, node.leaves, node.saved]
            if node.key is not None:
                self.rows.append([SHARE, node.key, above and above.key, *numbers, None, self.number, 0])
            else:
                ends = node.digest.hexdigest()
                self.finish(node, above, [NODE, node.name, None, *numbers, ends, self.number, 0])
            if above:
                above.count += node.count
                above.least = node.least if above.least is None else min(above.least, node.least)
                above.children += ended
                above.leaves += node.leaves
                above.saved += node.saved
                above.parted = True

    def finish(self, node: Node, above: Node | None, row: list) -> None:
        """A node off the skeleton. Its parent's id is known when that closes, or by name after all shards."""
        for child in node.held:
            child[5] = node.least
        self.rows += node.held
        if above is None:
            self.rows.append(row)
        elif above.key is not None:
            row[2] = above.key
            self.rows.append(row)
        else:
            above.held.append(row)
            if len(above.held) >= self.most_held:
                above.name = keys_along(self.path[: STEP * (len(self.open) - 1)])[-1]
                for child in above.held:
                    child[2] = above.name
                self.rows += above.held
                above.held = []

    def end(self) -> None:
        self.close(-1, -1 if self.right is None else in_common(self.path, self.right))


def prefix_trie(rows: DataFrame, shards: int | None = None, held: int = HELD) -> DataFrame:
    """The nodes of the trie of ``rows`` (``conv_id``, ``turns``): see ``RESULT``.

    A node is a way to begin; the root, the empty one, has every conversation as a member, also one without
    turns. ``conv_id`` is a node's smallest member and with ``depth`` names it, ``parent_conv_id`` its
    parent's (NULL for the root), ``n_convs`` counts members, ``n_children`` the nodes one turn longer,
    ``n_leaves`` the childless nodes in the subtree, top included. ``saved_tokens`` sums, over the subtree,
    the bytes of each node's last text times its members but one. ``ends_sha256`` is of the ascending ids of
    the members that end there, joined by commas. ``conv_id`` is unique and not NULL in ``rows``, as
    ``sequences`` gives it; other columns are ignored; no conversations give no nodes, not even the root.
    """
    spark = rows.sparkSession
    joined = F.array_join(F.transform("turns", lambda t: t["key"]), "")
    paths = keep(
        rows.select("conv_id", F.unhex(joined).alias("path"), F.col("turns.size").alias("sizes")), "paths"
    )
    if shards is None:
        wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
        shards = min(max(wanted, paths.count() // SHARD_ROWS), MOST_SHARDS)
    cuts = splitters(paths, shards)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
            numbers = [bisect.bisect_right(cuts, pair) for pair in pairs]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(numbers, pa.int32())], names=["conv_id", "path", "sizes", "shard"]
            )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, found = None, []

        def given() -> pa.RecordBatch:
            columns = zip(*found, strict=True) if found else [[]] * len(PARTS)
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, PARTS, strict=True)], schema=PARTS
            )
            found.clear()
            return batch

        for batch in batches:
            for conv_id, path, sizes, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard is None or shard.number != number:
                    if shard is not None:
                        shard.end()
                    shard = Shard(number, cuts, found, held)
                shard.add(path, conv_id, sizes)
                if len(found) >= 10_000:
                    yield given()
        if shard is not None:
            shard.end()
        yield given()

    dealt = paths.mapInArrow(deal, "conv_id long, path binary, sizes array<long>, shard int")
    shards_of = dealt.repartitionById(len(cuts) + 1, F.col("shard"))
    in_order = shards_of.sortWithinPartitions("shard", "path", "conv_id")
    return reduced(keep(in_order.mapInArrow(read, from_arrow_schema(PARTS)), "trie"))


def reduced(parts: DataFrame) -> DataFrame:
    """All nodes, from what the shards gave: the shares of a skeleton node are summed, its list put together."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chain = None, None
        for batch in batches:
            rows = []
            for own, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own == key:
                    chain.update(f",{text}".encode())
                else:
                    if chain is not None:
                        rows.append((key, chain.hexdigest()))
                    key, chain = own, hashlib.sha256(text.encode())
            if rows:
                yield _listed(rows)
        if chain is not None:
            yield _listed([(key, chain.hexdigest())])

    lists = parts.where(F.col("kind") == MEMBERS).select("key", "shard", "part", "ends")
    in_order = lists.repartition("key").sortWithinPartitions("key", "shard", "part").select("key", "ends")
    ends = in_order.mapInArrow(digest, "key binary, ends_sha256 string")
    shares = parts.where(F.col("kind") == SHARE)
    summed = shares.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"),
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        *(F.sum(name).alias(name) for name in NUMBERS),
    )
    ends_of = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    skeleton = keep(summed.join(ends, "key", "left").select(*summed.columns, ends_of), "skeleton")
    nodes = parts.where(F.col("kind") == NODE).withColumnRenamed("ends", "ends_sha256")
    finished = nodes.where(F.col("parent_key").isNull()).select(*RESULT)
    named = nodes.where(F.col("key").isNotNull()).select("key", "conv_id")
    parents = keep(skeleton.select("key", "conv_id").unionByName(named), "parents").select(
        F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")
    )
    columns = ("parent_key", *(c for c in RESULT if c != "parent_conv_id"))
    held = nodes.where(F.col("parent_key").isNotNull()).select(*columns)
    waiting = held.unionByName(skeleton.select(*columns))
    return finished.unionByName(waiting.join(parents, "parent_key", "left").select(*RESULT))


def _listed(rows: list[tuple]) -> pa.RecordBatch:
    keys, ends = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(ends, pa.string())], names=["key", "ends_sha256"]
    )
