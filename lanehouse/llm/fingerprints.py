"""Document fingerprints: invertible Bloom lookup sketches of a text's paragraphs.

A paragraph is a line or, in longer lines, a sentence; its digest is a 64-bit hash, and a text is the set
of its digests. A sketch has three tables of cells. A digest goes to one cell of each table, which counts its
digests and keeps their exclusive or and that of their check sums. Cells of two texts subtract: what they
share is gone, and a cell left with a single digest gives it away; taking that one out of its other cells
lays more of them bare, until all differing digests are found. Where that gets stuck, it is tried again
with a larger sketch: digests are dealt by hash into blocks of a few, each with cells of its own.

Only Spark's own functions are used, so the sketches are plain columns.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanehouse.llm.frames import texts

#: cells in each of the three tables of a sketch
SIDE = 8
#: digests per block of a larger sketch, and the seeds of the tries for a block that gets stuck
PER_BLOCK = 8
RETRIES = (2, 3)
#: blocks that are cut out of a text together
SPAN = 16
#: buckets of neighbouring documents for each shuffle partition
BUCKETS_PER_PARTITION = 4


def paragraphs(text: Column) -> Column:
    for mark in ".!?":
        text = F.replace(text, F.lit(f"{mark} "), F.lit(f"{mark}\n"))
    parts = F.transform(F.split(text, "\n"), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def digests(text: Column) -> Column:
    return F.array_distinct(F.transform(paragraphs(text), lambda p: F.xxhash64(p)))


def _bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _places(digest: Column, seed: int) -> list[Column]:
    """The cell of the digest in each of the three tables, as cells of one row of tables."""
    return [
        (F.pmod(F.xxhash64(digest, F.lit(3 * seed + table)), F.lit(SIDE)) + table * SIDE).cast("int")
        for table in range(3)
    ]


def _entry(digest: Column, sign: Column, seed: int) -> Column:
    a, b, c = _places(digest, seed)
    return F.struct(
        digest.alias("k"), F.hash(digest).alias("c"), sign.alias("n"), a.alias("t0"), b.alias("t1"), c.alias("t2")
    )


def _cells(entries: Column) -> Column:
    """The sketch of signed entries: count, digests and check sums per cell."""

    def cell(mine: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).alias("c"))
        return F.aggregate(
            mine,
            start,
            lambda s, e: F.struct(
                (s["n"] + e["n"]).alias("n"),
                s["k"].bitwiseXOR(e["k"]).alias("k"),
                s["c"].bitwiseXOR(e["c"]).alias("c"),
            ),
        )

    def row(table: int) -> Column:
        places = F.sequence(F.lit(table * SIDE), F.lit(table * SIDE + SIDE - 1))
        return F.transform(places, lambda i: cell(F.filter(entries, lambda e: e[f"t{table}"] == i)))

    return F.concat(*map(row, range(3)))


def sketch(found: Column) -> Column:
    """The cells of a set of digests: a fingerprint that subtracts."""
    return _bind(F.transform(found, lambda d: _entry(d, F.lit(1), 0)), _cells)


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(
        left,
        right,
        lambda a, b: F.struct(
            (a["n"] - b["n"]).alias("n"),
            a["k"].bitwiseXOR(b["k"]).alias("k"),
            a["c"].bitwiseXOR(b["c"]).alias("c"),
        ),
    )


def peel(cells: Column, steps: Column, seed: int) -> Column:
    """The digests left in ``cells``, negative ones for the subtracted side's; NULL if it gets stuck.

    Gives an array of (digest, sign). ``steps`` bounds the number of digests that can be there.
    """
    none = F.array().cast("array<struct<k:bigint,n:int>>")
    start = F.struct(cells.alias("cells"), none.alias("found"))

    def step(state: Column, _: Column) -> Column:
        alone = F.transform(
            state["cells"], lambda x: (F.abs(x["n"]) == 1) & (x["c"] == F.hash(x["k"]))
        )
        at = F.array_position(alone, F.lit(True)).cast("int")

        def take(entry: Column) -> Column:
            def without(x: Column, i: Column) -> Column:
                hit = (entry["t0"] == i) | (entry["t1"] == i) | (entry["t2"] == i)
                return F.when(
                    hit,
                    F.struct(
                        (x["n"] - entry["n"]).alias("n"),
                        x["k"].bitwiseXOR(entry["k"]).alias("k"),
                        x["c"].bitwiseXOR(entry["c"]).alias("c"),
                    ),
                ).otherwise(x)

            item = F.struct(entry["k"].alias("k"), entry["n"].alias("n"))
            return F.struct(
                F.transform(state["cells"], without).alias("cells"),
                F.concat(state["found"], F.array(item)).alias("found"),
            )

        def follow(at: Column) -> Column:
            cell = F.element_at(state["cells"], at)
            return F.when(at == 0, state).otherwise(
                _bind(_entry(cell["k"], cell["n"], seed), take)
            )

        return _bind(at, follow)

    def finish(state: Column) -> Column:
        left = F.exists(state["cells"], lambda x: (x["n"] != 0) | (x["k"] != 0) | (x["c"] != 0))
        return F.when(~left, state["found"])

    peeled = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), steps)), start, step, finish)
    # most of what gets stuck is so from the beginning
    open_ = F.exists(cells, lambda x: (F.abs(x["n"]) == 1) & (x["c"] == F.hash(x["k"])))
    empty = ~F.exists(cells, lambda x: (x["n"] != 0) | (x["k"] != 0) | (x["c"] != 0))
    return F.when(empty, none).when(open_, peeled)


def _halves(entries: Column, seed: int) -> Column:
    """The differing digests of a block that got stuck, from twice as many cells with other places."""
    again = F.transform(entries, lambda e: _entry(e["k"], e["n"], seed))

    def half(which: int) -> Column:
        mine = F.filter(again, lambda e: F.pmod(F.xxhash64(e["k"], F.lit(-1 - seed)), F.lit(2)) == which)
        return _bind(mine, lambda own: _bind(_cells(own), lambda cells: peel(cells, F.size(own), seed)))

    return F.flatten(F.array(half(0), half(1)))


def _exactly(entries: Column) -> Column:
    alone = F.filter(
        entries, lambda e: ~F.exists(entries, lambda f: (f["k"] == e["k"]) & (f["n"] != e["n"]))
    )
    return F.transform(alone, lambda e: F.struct(e["k"].alias("k"), e["n"].alias("n")))


def _larger(left: Column, right: Column) -> Column:
    """The differing digests from one sketch per block; a block that gets stuck is tried again by itself."""
    signed = F.concat(
        F.transform(left, lambda d: _entry(d, F.lit(1), 1)),
        F.transform(right, lambda d: _entry(d, F.lit(-1), 1)),
    )
    blocks = F.greatest(F.lit(1), F.ceil((F.size(left) + F.size(right)) / PER_BLOCK)).cast("int")

    def dealt(n: Column):
        return lambda d: F.struct(
            F.pmod(F.xxhash64(d["k"], F.lit(-1)), n).cast("int").alias("block"), d.alias("entry")
        )

    def solve(bound: Column) -> Column:
        n = bound["blocks"]

        def one(own: Column) -> Column:
            first = _bind(_cells(own), lambda cells: peel(cells, F.size(own), 1))
            return F.coalesce(first, *(_halves(own, seed) for seed in RETRIES), _exactly(own))

        def span(g: Column) -> Column:
            mine = F.filter(bound["entries"], lambda e: F.floor(e["block"] / SPAN) == g)
            low, high = (g * SPAN).cast("int"), F.least(g * SPAN + SPAN - 1, n - 1).cast("int")

            def each(part: Column) -> Column:
                def block(b: Column) -> Column:
                    own = F.filter(part, lambda e: e["block"] == b)
                    return _bind(F.transform(own, lambda e: e["entry"]), one)

                return F.flatten(F.transform(F.sequence(low, high), block))

            return _bind(mine, each)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.floor((n - 1) / SPAN).cast("int")), span))

    together = F.struct(F.transform(signed, dealt(blocks)).alias("entries"), blocks.alias("blocks"))
    return _bind(together, solve)


def differences(left: Column, right: Column, left_cells: Column, right_cells: Column) -> Column:
    """The digests that only one of two texts has, as (digest, 1 or -1).

    Tries the fingerprints, then a larger sketch of the digests, which always ends: a block that stays
    stuck through all tries compares its few digests themselves.
    """
    most = F.least(F.size(left) + F.size(right), F.lit(3 * SIDE))
    return F.coalesce(
        _bind(subtract(left_cells, right_cells), lambda cells: peel(cells, most, 0)), _larger(left, right)
    )


def likeness(left: Column, right: Column, differing: Column) -> Column:
    """Shared digests over all digests of two texts; 1 if neither has any."""
    everything = F.size(left) + F.size(right)
    return F.when(everything == 0, 1.0).otherwise(
        (everything - F.size(differing)) / (everything + F.size(differing))
    )


def as_text(cells: Column) -> Column:
    """A fingerprint as text: 16 bytes per cell in base 64."""
    each = F.transform(
        cells,
        lambda x: F.concat(
            F.lpad(F.hex(x["n"].cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"),
            F.lpad(F.hex(x["k"]), 16, "0"),
            F.lpad(F.hex(x["c"].cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"),
        ),
    )
    return F.base64(F.unhex(F.array_join(each, "")))


def bucket_bounds(ids: list[int], without: int) -> list[tuple[int | None, int]]:
    """Where buckets begin, as pairs of an id and a hash, from the quantiles of the ids.

    An id that several quantiles fall on has the rows of several buckets, as have the rows without an id for
    ``without`` buckets: these are cut at equal steps of the hash.
    """
    bounds: list[tuple[int | None, int]] = []
    times = Counter(ids)
    for i, n in [(None, without), *sorted(times.items())]:
        first = [] if i is None else [(i, -(1 << 63))]
        bounds += first + [(i, (k << 64) // n - (1 << 63)) for k in range(1, n)]
    return bounds


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id``, ``text`` and others) with ``next_``: the columns of the row after by ascending id.

    After the last comes the first. NULL ids come before all, equal ids go by their texts' hashes. Rows are
    dealt into buckets of neighbouring ids and hashes, see ``bucket_bounds``; the first row of a bucket also
    goes to the bucket before it. So one shuffle by bucket brings each row to its neighbour, and the driver
    sees a few rows per partition.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) * BUCKETS_PER_PARTITION
    shares = [k / buckets for k in range(1, buckets)]
    stats = docs.agg(
        F.percentile_approx("doc_id", shares, 10 * buckets).alias("ids"),
        F.count_if(F.col("doc_id").isNull()).alias("without"),
        F.count(F.lit(1)).alias("rows"),
    ).first()
    bounds = bucket_bounds(stats["ids"] or [], stats["without"] * buckets // max(stats["rows"], 1))

    def pair(known: Column, i: Column, tie: Column) -> Column:
        number = F.coalesce(i, F.lit(0)).cast("long")
        return F.struct(known.alias("known"), number.alias("id"), tie.cast("long").alias("tie"))

    edges = F.array(*(pair(F.lit(i is not None), F.lit(i or 0), F.lit(t)) for i, t in bounds))
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    tie = F.xxhash64("text")
    own = pair(F.col("doc_id").isNotNull(), F.col("doc_id"), tie)

    def further(at: Column, step: Column) -> Column:
        there = F.element_at(edges, F.least(at + step, F.lit(len(bounds))))
        fits = (at + step <= len(bounds)) & (there <= own)
        return F.when(fits, at + step).otherwise(at)

    bucket = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further) if bounds else F.lit(0)
    placed = docs.withColumns({"bucket": bucket, "tie": tie})
    first = [
        (r.bucket, r.first.doc_id, r.first.tie)
        for r in placed.groupBy("bucket").agg(F.min(F.struct("doc_id", "tie")).alias("first")).collect()
    ]
    first.sort(key=lambda r: r[0])
    before = [first[k - 1][0] for k in range(len(first))]
    starts = spark.createDataFrame(
        [(*row, previous) for row, previous in zip(first, before, strict=True)],
        "bucket int, first_id long, first_tie long, previous int",
    )
    # at most one row per bucket
    marked = placed.join(F.broadcast(starts), "bucket")
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("tie") == F.col("first_tie"))
    own = F.struct(F.lit(0).alias("guest"), F.col("bucket").alias("at"))
    guest = F.struct(F.lit(1).alias("guest"), F.col("previous").alias("at"))
    dealt = marked.select(
        *docs.columns, "tie", F.inline(F.when(is_first, F.array(own, guest)).otherwise(F.array(own)))
    )
    in_order = Window.partitionBy("at").orderBy("guest", F.col("doc_id").asc_nulls_first(), "tie")
    following = dealt.select(
        "guest", *docs.columns, *(F.lead(name).over(in_order).alias(f"next_{name}") for name in docs.columns)
    )
    return following.where("guest = 0").drop("guest", "next_doc_id")


def edited_text(text: Column, following: Column) -> Column:
    """``text`` whose second half is replaced by the beginning of ``following``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they and the next text's are.

    Gives ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``,
    ``near_next``, and ``edited_removed`` and ``edited_added``: the recovered digests that only the text or
    only the edited text has. Likeness is the shared share of all distinct digests. NULL text is empty; texts
    without a paragraph have an empty set and are fully alike. A NULL ``doc_id`` stays and counts as
    smallest; repeated rows give a row each, the next of the first being the second; a single row is its own
    next; other columns are ignored; no rows give none.
    """
    own_sets = texts(docs).withColumn("own", digests(F.col("text")))
    pairs = with_next(own_sets).withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    sets = pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "own",
        digests(F.col("edited")).alias("changed"),
        F.col("next_own").alias("after"),
    )
    cells = sets.withColumns({f"{name}_cells": sketch(F.col(name)) for name in ("own", "changed", "after")})
    own, changed, after = F.col("own"), F.col("changed"), F.col("after")
    found = cells.withColumns(
        {
            "to_changed": differences(own, changed, F.col("own_cells"), F.col("changed_cells")),
            "to_after": differences(own, after, F.col("own_cells"), F.col("after_cells")),
        }
    )

    def only(sign: int) -> Column:
        return F.transform(F.filter("to_changed", lambda d: d["n"] == sign), lambda d: d["k"])

    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own_cells")).alias("fingerprint"),
        as_text(F.col("changed_cells")).alias("edited_fingerprint"),
        likeness(own, changed, F.col("to_changed")).alias("near_edited"),
        likeness(own, after, F.col("to_after")).alias("near_next"),
        only(1).alias("edited_removed"),
        only(-1).alias("edited_added"),
    )
