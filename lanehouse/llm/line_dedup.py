"""Removal of boilerplate lines by their frequency within a site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanehouse.llm.frames import free, keep

#: a line is boilerplate on more than this share of a host's pages, and on so many pages at least
MAX_RATIO, MIN_PAGES = 0.1, 2


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """128 bits that stand for a line without the spaces around it."""
    return F.struct(F.xxhash64(F.trim(line)).alias("a"), F.xxhash64(F.lit(1), F.trim(line)).alias("b"))


def boilerplate(
    docs: DataFrame, host: str, ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``host`` and ``drop``: the keys of the lines on more than ``ratio`` of the host's pages.

    A page counts once for a line however often it has it. A host has at most (distinct lines of its
    average page) / ``ratio`` such lines, so the list stays small on the largest host. Pages whose host is
    NULL are those of one more host.
    """
    pages = docs.select(F.col(host).alias("host"), F.col("text"))
    filled = F.filter(lines_of(F.col("text")), lambda line: F.trim(line) != "")
    frequent = (
        pages.select("host", F.explode(F.array_distinct(F.transform(filled, line_key))).alias("line"))
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_pages)
    )
    totals = pages.groupBy(F.col("host").alias("whose")).agg(F.count(F.lit(1)).alias("pages"))
    return (
        frequent.join(totals, frequent["host"].eqNullSafe(totals["whose"]))
        .where(F.col("n") > ratio * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list("line").alias("drop"))
    )


def drop_boilerplate(
    docs: DataFrame, host: str = "source", ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``docs`` with ``text`` without boilerplate lines, and ``n_lines`` and ``n_dropped`` added.

    Lines are what stands between line feeds; spaces around a line don't matter, blank lines stay. NULL
    text becomes empty text of one line. Pages whose host is NULL make one host; a line has to be on
    ``min_pages`` pages, so a host's only page stays whole. Repeated rows are pages of their own. Other
    columns are kept as they are, except for earlier columns named ``n_lines`` and ``n_dropped``, which are
    replaced.
    """
    docs = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    # written first: a short list is then seen to be one, and joined without a shuffle of the texts
    drop = keep(boilerplate(docs, host, ratio, min_pages), "boilerplate")
    own_host, own_lines = free(docs, "_drop_host"), free(docs, "_drop_lines")
    drop = drop.select(F.col("host").alias(own_host), F.col("drop").alias(own_lines))
    found = docs.join(drop, docs[host].eqNullSafe(drop[own_host]), "left")
    lines, gone = lines_of(F.col("text")), F.col(own_lines)
    kept = F.filter(
        lines, lambda line: (F.trim(line) == "") | ~F.array_contains(gone, line_key(line))
    )
    n = F.size(lines)
    cleaned = found.withColumns(
        {
            "n_lines": n,
            "n_dropped": F.when(gone.isNull(), 0).otherwise(n - F.size(kept)),
            "text": F.when(gone.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")),
        }
    )
    return cleaned.drop(own_host, own_lines)
