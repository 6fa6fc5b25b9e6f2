"""Operators that depend on the order of rows. Every one takes an explicit order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators.keys import join_null_safe
from lanehouse.operators.levels import indexes_within
from lanehouse.session import settle


def carry_forward(
    rows: DataFrame,
    group: Sequence[str],
    order: str,
    carried: Sequence[str],
    span: int | None = 1 << 20,
    block: str | None = None,
    keep: Column | None = None,
) -> DataFrame:
    """Fill each carried column with its latest known value up to and including the row.

    ``order`` is a whole number. A group may be of any length: it is cut into blocks of ``span``
    positions, or where ``block`` names a column, such as the offset of a file split, by that column,
    with ``order`` counting within it. Blocks are filled on their own with one shuffle and written;
    what a block inherits comes from the last rows of the earlier ones, one row per block.
    ``span=None`` is for groups that are bounded anyway, such as the lines of one text cell.
    ``keep`` tells the rows to return, if not all; it must not look at a carried column.
    """
    group = list(group)
    keep = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    whole = span is None and block is None
    cut = F.col(block) if block is not None else F.floor(F.col(order) / (span or 1))
    keys = group if whole else [*group, "_block"]
    place = Window.partitionBy(*keys).orderBy(order)
    upto = place.rowsBetween(Window.unboundedPreceding, 0)
    fill = {c: F.last(c, ignorenulls=True).over(upto) for c in carried}
    if whole:
        return rows.withColumns(fill).where(keep)
    ends_block = F.lead(F.lit(True)).over(place).isNull()
    filled = rows.withColumn("_block", cut).withColumns(fill | {"_ends_block": ends_block})
    blocks = settle(filled.where(keep | F.col("_ends_block")), "blocks")
    earlier = (
        Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    inherited = settle(
        blocks.where("_ends_block").select(
            *keys,
            *(F.last(c, ignorenulls=True).over(earlier).alias(f"_inherited_{c}") for c in carried),
        ),
        "block-starts",
    )
    return (
        join_null_safe(blocks.where(keep), inherited, keys)
        .withColumns({c: F.coalesce(F.col(c), F.col(f"_inherited_{c}")) for c in carried})
        .select(*rows.columns)
    )


def after_context(
    lines: DataFrame,
    hit: Column,
    group: Sequence[str],
    pos: str = "pos",
    n: int = 1,
    span: int = 1 << 16,
) -> DataFrame:
    """Lines that match and the ``n`` lines after each.

    ``pos`` counts the lines of a group without gaps. A group is cut into blocks of ``span`` lines, which
    find their matches by themselves; a match near the end of its block also goes to the blocks that it
    reaches into. So the lines are read and moved once, no join meets them, and no group has to fit a task.
    """
    own_block, last_block = (F.floor(F.col(pos) / span), F.floor((F.col(pos) + n) / span))
    marked = lines.withColumn("_hit", F.when(hit, F.col(pos)))
    blocks = F.when(
        F.col("_hit").isNotNull() & (last_block > own_block), F.sequence(own_block, last_block)
    ).otherwise(F.array(own_block))
    dealt = marked.withColumn("_block", F.explode(blocks))
    place = Window.partitionBy(*group, "_block").orderBy(pos)
    upto = place.rowsBetween(Window.unboundedPreceding, 0)
    near = F.col(pos) - F.last("_hit", ignorenulls=True).over(upto) <= n
    return (
        dealt.withColumn("_near", near)
        .where(F.col("_near") & (F.col("_block") == own_block))
        .select(*lines.columns)
    )


def context_of_text(text: Column, word: str, n: int = 1) -> Column:
    """The same within one text: an array of (pos, line) for whole-word matches and what follows."""

    def spots(lines: Column) -> Column:
        def near(spot: Column) -> Column:
            start = F.greatest(spot["pos"] - n, F.lit(0))
            reach = F.slice(lines, start + 1, spot["pos"] - start + 1)
            return F.exists(reach, lambda line: fn.has_word(line, word))

        numbered = F.transform(
            lines, lambda line, pos: F.struct(pos.alias("pos"), line.alias("line"))
        )
        return F.filter(numbered, near)

    # the text is split once: inside the lambda the lines are a value, not an expression
    return F.flatten(F.transform(F.array(fn.text_lines(text)), spots))


def sections_of_text(text: Column, is_head: Callable[[Column], Column]) -> Column:
    """One text cut at its head lines: an array of (start, head, lines).

    A section runs from a head line to the line before the next; lines before the first head are a
    section with a NULL head. It carries the head to its lines within the cell, without a shuffle.
    """

    def sections(lines: Column) -> Column:
        marks = F.filter(
            F.transform(lines, lambda line, pos: F.when(is_head(line), pos)), lambda pos: pos > 0
        )
        spans = F.arrays_zip(
            F.concat(F.array(F.lit(0)), marks).alias("start"),
            F.concat(marks, F.array(F.size(lines))).alias("stop"),
        )

        def section(span: Column) -> Column:
            first = F.get(lines, span["start"])
            return F.struct(
                span["start"].alias("start"),
                F.when(is_head(first), first).alias("head"),
                F.slice(lines, span["start"] + 1, span["stop"] - span["start"]).alias("lines"),
            )

        return F.transform(spans, section)

    return F.flatten(F.transform(F.array(fn.text_lines(text)), sections))


def index_within(df: DataFrame, parents: Sequence[str], column: str, as_column: str) -> DataFrame:
    """Ours: number the distinct values of ``column`` within its parents, from 1 in their order."""
    return indexes_within(df, parents, {column: as_column})


def slots(
    df: DataFrame, group: Sequence[str], order: Sequence[str], k: int, as_column: str = "slot"
) -> DataFrame:
    """The first ``k`` rows of each group with their slot from 1.

    The planner limits the groups before the shuffle, so a task receives at most ``k`` rows of a
    group from each other task.
    """
    place = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn(as_column, F.row_number().over(place))
        .where(F.col(as_column) <= k)
        .withColumn(as_column, F.col(as_column).cast("long"))
    )


def lane_or_rest(
    files: DataFrame, path: str, pattern: str = r"/L00([1-8])/", rest: str = "additional"
) -> DataFrame:
    """Ours: the lane named in the path, or ``additional``."""
    lane = F.regexp_extract(path, pattern, 1)
    return files.withColumn("lane", F.when(lane == "", F.lit(rest)).otherwise(lane))


def first_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def pick_one(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return first_n(df, order, 1)
