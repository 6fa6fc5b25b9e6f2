"""Near-duplicate texts by DartMinHash signatures and banded joining.

The elements of a text are its shingles of five words, of weight 1 or as often as they occur. In the plane over
each element, with weight on one axis and rank on the other, darts fall at random places that depend on the
element alone, one to a unit of area on average. A text sees the darts below its elements' weights; every dart
belongs to one of ``k`` coordinates, and of each coordinate the dart of lowest rank makes the signature.
Two texts agree in a coordinate with the probability of their (weighted) Jaccard similarity. Only darts below a
rank that leaves about ``k ln k + 2k`` of them are thrown, so the work doesn't grow with ``k`` times the
text; where a coordinate stays empty, the rank is doubled.

Signatures are cut into bands. All texts with an equal band make a bucket, and whether two of a bucket
are similar is decided on their whole sets of shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from lanehouse.llm.frames import cut, free, keep, texts, utf8
from lanehouse.llm.graphs import components
from lanehouse.llm.words import mix, words_of

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: at the similarity of 0.8 a pair shares none of the bands with a probability of 3e-6
BANDS, ROWS = 32, 5
#: members of one bucket that are compared in one task; larger ones are cut and compared part by part
BLOCK = 1000

#: bytes of text that are worked on at a time; a text of some words has as many darts as a long one
SLICE_BYTES = 1 << 18

HASHES = pa.list_(pa.int64())


def shingles(data: np.ndarray, bounds: np.ndarray, size: int = SHINGLE_WORDS):
    """Distinct shingles of each text: hash, text and number of occurrences, by text and hash.

    A text of fewer words than ``size``, but one at least, has a single shingle of all its words.
    """
    word, text = words_of(data, bounds, lower=False)
    n = len(bounds) - 1
    count = np.bincount(text, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    odd = np.uint64(0xD6E8FEB86659FD93)
    parts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for length in range(1, size + 1):
        # starts of the shingles of this length: whole short texts, or everywhere in the others
        if length < size:
            start = first[count == length]
        else:
            start = np.flatnonzero(np.arange(len(word)) + size <= (first + count)[text])
        if len(start):
            value = np.full(len(start), length, dtype=np.uint64)
            for k in range(length):
                value = mix(value * odd + word[start + k])
            parts[0].append(value)
            parts[1].append(text[start])
    value, owner = np.concatenate(parts[0]), np.concatenate(parts[1])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    place = np.flatnonzero(new)
    return value[place], owner[place], np.diff(np.append(place, len(value)))


def _uniform(bits: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from 64 random bits."""
    return ((bits >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def _throw(element: np.ndarray, weight: np.ndarray, owner: np.ndarray, limit: np.ndarray):
    """The darts within each element's weight and below its rank ``limit``: identity, rank and owner.

    The weight axis is cut into strips of width 1; in a strip the ranks of the darts have exponential
    steps, so a strip is followed upwards until it leaves the limit.
    """
    strips = np.ceil(weight).astype(np.int64)
    which = np.repeat(np.arange(len(element)), strips)
    strip = np.arange(len(which)) - np.repeat(np.cumsum(strips) - strips, strips)
    seed = mix(element[which] ^ mix(strip.astype(np.uint64) + np.uint64(0x51ED27)))
    rank = np.zeros(len(which))
    found = [], [], []
    step = 0
    while len(which):
        step += 1
        dart = mix(seed + np.uint64(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        rank = rank - np.log(_uniform(dart))
        below = rank < limit[which]
        which, strip, seed, rank, dart = which[below], strip[below], seed[below], rank[below], dart[below]
        inside = strip + _uniform(mix(dart ^ np.uint64(0xA5A5A5))) <= weight[which]
        for column, values in zip(found, (dart, rank, owner[which]), strict=True):
            column.append(values[inside])
    return [np.concatenate(column) if column else np.zeros(0) for column in found]


def signatures(
    element: np.ndarray, weight: np.ndarray, owner: np.ndarray, n: int, k: int
) -> np.ndarray:
    """A row of ``k`` darts per owner 0 to ``n`` - 1; zeros for owners without elements.

    ``owner`` rises. Equal weighted sets have equal rows, whatever stands beside them.
    """
    result = np.zeros((n, k), dtype=np.uint64)
    total = np.bincount(owner, weight, minlength=n)
    todo = np.flatnonzero(total > 0)
    factor = 1.0
    while len(todo):
        own = np.zeros(n, dtype=bool)
        own[todo] = True
        mine = own[owner]
        wanted = factor * (k * math.log(k + 1) + 2 * k)
        limit = wanted / total[owner[mine]]
        dart, rank, of = _throw(element[mine], weight[mine], owner[mine], limit)
        # from the highest rank down, so that the lowest is written last
        order = np.argsort(-rank, kind="stable")
        dart, of = dart[order].astype(np.uint64), of[order].astype(np.int64)
        part = np.zeros((n, k), dtype=np.uint64)
        part[of, (mix(dart) % np.uint64(k)).astype(np.int64)] = dart | np.uint64(1)
        full = own & part.all(axis=1)
        result[full] = part[full]
        todo = np.flatnonzero(own & ~full)
        factor *= 2
    return result


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; equal in two rows if and (but for chance) only if the band is."""
    keys = np.empty((len(signature), bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(len(signature), band + 1, dtype=np.uint64)
        for row in range(rows):
            key = mix(key * np.uint64(0xD6E8FEB86659FD93) + signature[:, band * rows + row])
        keys[:, band] = key
    return keys


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int64)))


def _with_keys(bands: int, rows: int, counted: bool):
    schema = pa.schema([("doc_id", pa.int64()), ("hash", pa.binary()), ("keys", HASHES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, size=SLICE_BYTES):
            n = batch.num_rows
            element, owner, times = shingles(*utf8(batch.column("text")))
            weight = times.astype(float) if counted else np.ones(len(element))
            keys = band_keys(signatures(element, weight, owner, n, bands * rows), bands, rows)
            some = np.bincount(owner, minlength=n) > 0
            lists = _lists(keys.view(np.int64)[some].ravel(), some * bands)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("hash"), lists], schema=schema
            )

    return run, from_arrow_schema(schema)


def _with_sets(counted: bool):
    schema = pa.schema([("id", pa.int64()), ("shingles", HASHES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, size=SLICE_BYTES):
            element, owner, times = shingles(*utf8(batch.column("text")))
            if counted:
                # each occurrence is an element, which makes weighted and plain similarity the same
                number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                element = mix(np.repeat(element, times) + number.astype(np.uint64))
                owner = np.repeat(owner, times)
            sizes = np.bincount(owner, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), _lists(element.view(np.int64), sizes)], schema=schema
            )

    return run, from_arrow_schema(schema)


EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _compare(similarity: float):
    """Links between the different components of a bucket, as many as connect what is similar."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        part = table.column("half").to_numpy()
        component = table.column("component").to_numpy()
        lists = table.column("shingles").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        value, code = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        owner = np.repeat(np.arange(len(ids)), sizes)
        shared = np.bincount(code, minlength=len(value)) > 1
        place = np.cumsum(shared) - 1
        used = shared[code]
        column, row = place[code[used]], owner[used]
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[order]
        left, right = np.flatnonzero(part != 2), np.flatnonzero(part != 1)
        both = np.zeros((len(ids), len(ids)), dtype=np.float32)
        step = 4096
        for first in range(0, int(shared.sum()), step):
            low, high = np.searchsorted(column, [first, first + step])
            cells = np.zeros((len(ids), step), dtype=np.float32)
            cells[row[low:high], column[low:high] - first] = 1
            both[np.ix_(left, right)] += cells[left] @ cells[right].T
        either = sizes[:, None] + sizes[None, :] - both
        linked = (both >= similarity * either - 1e-6) & (component[:, None] != component[None, :])
        root = {int(c): int(c) for c in np.unique(component)}

        def top(c: int) -> int:
            while root[c] != c:
                c = root[c]
            return c

        edges = []
        for i, j in zip(*np.nonzero(linked), strict=True):
            a, b = top(int(component[i])), top(int(component[j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((ids[i], ids[j]))
        return pa.Table.from_arrays(
            [pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], schema=EDGES
        )

    return run


def similar_to_first(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``a`` and ``b``: members of buckets that are similar to the first of the bucket."""
    pairs = members.where("id != first").select("id", "first").distinct()
    mine = sets.select("id", F.col("shingles").alias("mine"))
    theirs = sets.select(F.col("id").alias("first"), F.col("shingles").alias("theirs"))
    shared = F.size(F.array_intersect("mine", "theirs"))
    either = F.size("mine") + F.size("theirs") - shared
    return (
        pairs.join(mine, "id")
        .join(theirs, "first")
        .where(shared >= similarity * either - 1e-6)
        .select(F.col("id").alias("a"), F.col("first").alias("b"))
    )


def similar_across(
    members: DataFrame, sets: DataFrame, known: DataFrame, similarity: float, block: int
) -> DataFrame:
    """Links between members of a bucket that are in different components so far.

    Every such pair of a bucket is compared, inside tasks, and only links that connect components leave
    them. A bucket of more than ``block`` members is cut by a hash into parts, and each two parts meet.
    Which buckets these are is written first: their rows then don't have to be dealt by bucket to be found.
    """
    label = F.coalesce("component", "id").alias("component")
    placed = members.where("n > 2").join(known, "id", "left").select("key", "n", "id", label)
    mixed = keep(
        placed.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low != high")
        .select("key"),
        "mixed",
    )
    parts = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("id"), parts).cast("int")
    # part i meets every part j: as the left half where i < j, as the right where i > j
    meets = F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda j: F.struct(
            F.least(own, j).alias("low"),
            F.greatest(own, j).alias("high"),
            F.when(own < j, 1).when(own > j, 2).otherwise(0).alias("half"),
        ),
    )
    dealt = (
        placed.join(mixed, "key")
        .select("key", "id", "component", F.inline(meets))
        .join(sets.select("id", "shingles"), "id")
    )
    return dealt.groupBy("key", "low", "high").applyInArrow(_compare(similarity), from_arrow_schema(EDGES))


def _classes(
    docs: DataFrame, similarity: float, bands: int, rows: int, block: int, weighted: bool
) -> DataFrame:
    """``doc_id``, ``hash`` of the text, ``component`` and ``class_id`` per row."""
    hashed = texts(docs).withColumn("hash", F.unhex(F.md5("text")))
    run, schema = _with_keys(bands, rows, weighted)
    signed = keep(hashed.mapInArrow(run, schema), "signatures")
    nodes = keep(
        signed.groupBy("hash")
        .agg(F.min("doc_id").alias("least"), F.first("keys").alias("keys"))
        .withColumn("id", F.monotonically_increasing_id()),
        "nodes",
    )
    banded = nodes.select("id", F.explode("keys").alias("key"))
    buckets = (
        banded.groupBy("key")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    members = keep(banded.join(buckets, "key"), "members")
    needed = nodes.select("id", "hash").join(members.select("id").distinct(), "id")
    whole = (
        hashed.select("hash", "text").join(needed, "hash").groupBy("id").agg(F.first("text").alias("text"))
    )
    sets = keep(whole.mapInArrow(*_with_sets(weighted)), "shingles")
    edges = keep(similar_to_first(members, sets, similarity), "links")
    known = components(edges)
    found = components(edges.union(similar_across(members, sets, known, similarity, block)))
    classes = (
        nodes.select("id", "hash", "least")
        .join(found, "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
    )
    named = classes.groupBy("component").agg(F.min("least").alias("class_id"))
    of_hash = classes.join(named, "component").select("hash", "component", "class_id")
    return signed.select("doc_id", "hash").join(of_hash, "hash")


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
    weighted: bool = False,
) -> DataFrame:
    """``doc_id`` and ``class_id`` per row: rows of a class are linked by similar texts.

    Two texts are linked if their sets of five-word shingles (with ``weighted``, their multisets) have a
    Jaccard similarity of ``similarity`` or more, or if they are equal; a class is what links connect, named
    by the smallest ``doc_id`` in it, NULL if it has none. Words are what white space separates. NULL text is
    the empty text; texts without words are linked to equal ones only. Repeated rows give a row each; other
    columns are ignored; no rows give none.

    Equal texts are one node from the start. Each bucket of a band first compares its members with its first
    one; then, only where a bucket still has several components, its members across these.
    """
    return _classes(docs, similarity, bands, rows, block, weighted).select("doc_id", "class_id")


def first_of_class(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
    weighted: bool = False,
) -> DataFrame:
    """``docs`` with one row of each class of ``near_duplicates``: the one with the smallest ``doc_id``.

    A row without id stays only where its class has none with an id. Of rows with the same id the one with
    the smallest hash of its text stays, of equal rows any one. All columns are kept.
    """
    found = _classes(docs, similarity, bands, rows, block, weighted)
    chosen = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash"))
    kept = (
        found.groupBy("component")
        .agg(chosen.alias("kept"))
        .select(F.col("kept.doc_id").alias("_kept_id"), F.col("kept.hash").alias("_kept_hash"))
    )
    text_hash = F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    own, kept_id, kept_hash = (free(docs, name) for name in ("_own_hash", "_kept_id", "_kept_hash"))
    kept = kept.withColumnsRenamed({"_kept_id": kept_id, "_kept_hash": kept_hash})
    marked = docs.withColumn(own, text_hash)
    same = marked["doc_id"].cast("long").eqNullSafe(kept[kept_id]) & (marked[own] == kept[kept_hash])
    return (
        marked.join(kept, same)
        .dropDuplicates([kept_id, kept_hash])
        .select(*(marked[name] for name in docs.columns))
    )
