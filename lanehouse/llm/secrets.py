"""Secrets in texts: fixed forms, and tokens that pass a battery of randomness tests.

All positions are code points. A token is tested against the alphabet of the encoding its symbols suggest:
are the symbols equally frequent (chi-squared), do high and low symbols alternate as by chance (runs), are
neighbours unrelated (serial correlation)? The least of the three p-values, corrected for their number,
says how badly "random" fits. Over all tokens of the table, "random" is rejected with a bound on the share
of false rejections (Benjamini and Hochberg), where a long token, on which the tests see more, weighs more.
What isn't rejected is reported.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanehouse.llm.frames import keep, texts

#: fixed values: the forms that are always reported, with the least length of what is measured
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

#: tokens that are tested, and the share of false rejections
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
FALSE_SHARE = 0.05
#: bins of p-values, so many to a power of ten
BINS, PER_DECADE = 160, 8

#: matches whose places are added up together
BLOCK = 256
SPAN_BLOCKS = "array<array<struct<start:int,end:int,token:string>>>"

#: encodings in the order in which they are tried: pattern of the whole token, and the symbols
ENCODINGS = (
    (r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", "0123456789abcdef"),
    (r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", "0123456789ABCDEF"),
    (r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    (r"^(?=.*[0-9])(?=.*[a-z])[a-z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    (r"^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (
        r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+$",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    ),
)


def matches(text: Column, pattern: str) -> Column:
    """Start, end and text of the leftmost non-overlapping matches, which are never empty.

    What stands between the matches gives their places. The pattern is searched a second time only in
    texts that have a match. Places are added up in blocks of matches and then over the blocks, as an
    array that grows match by match is copied each time.
    """
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:int,end:int,token:string>>")

    def add(so_far: Column, pair: Column) -> Column:
        start = so_far["at"] + F.length(pair["between"])
        end = start + F.length(pair["token"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["token"].alias("token"))
        return F.struct(end.alias("at"), F.concat(so_far["spans"], F.array(span)).alias("spans"))

    def within(pairs: Column, first: Column) -> Column:
        block = F.slice(pairs, first, F.lit(BLOCK))
        return F.aggregate(block, F.struct(F.lit(0).alias("at"), none.alias("spans")), add)

    def append(so_far: Column, block: Column) -> Column:
        moved = F.transform(
            block["spans"],
            lambda s: F.struct(
                (s["start"] + so_far["at"]).alias("start"), (s["end"] + so_far["at"]).alias("end"), s["token"].alias("token")
            ),
        )
        return F.struct(
            (so_far["at"] + block["at"]).alias("at"), F.concat(so_far["blocks"], F.array(moved)).alias("blocks")
        )

    def placed(pairs: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(pairs), F.lit(BLOCK))
        blocks = F.transform(firsts, lambda first: within(pairs, first))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN_BLOCKS).alias("blocks"))
        return F.aggregate(blocks, start, append, lambda state: F.flatten(state["blocks"]))

    pairs = F.arrays_zip(
        F.slice(between, F.lit(1), F.size(found)).alias("between"), found.alias("token")
    )
    # bound to a name, so that the text is searched once
    spans = F.transform(F.array(pairs), lambda bound: placed(bound))[0]
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(none)


def fixed_forms(text: Column) -> Column:
    """Spans of the fixed forms as (start, rank of kind, end)."""

    def spans(kind: str, pattern: str, long_enough) -> Column:
        kept = F.filter(matches(text, pattern), lambda m: long_enough(m["token"]))
        return F.transform(
            kept,
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")
            ),
        )

    # a longest run of these characters either is long enough or has no match within
    return F.concat(
        spans(
            "assign",
            ASSIGN,
            lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= LEAST_VALUE,
        ),
        spans("access", ACCESS[:-1] + f"{{{LEAST_ACCESS - 4},}}", lambda m: F.lit(True)),
        spans("hex", HEX[:-1] + f"{{{LEAST_HEX},}}+", lambda m: F.lit(True)),
    )


def normal_tail(z: Column) -> Column:
    """The share of the standard normal distribution above ``z`` (from 0 on), by a usual approximation."""
    t = 1 / (1 + 0.2316419 * z)
    terms = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    polynomial = F.lit(0.0)
    for a in reversed(terms):
        polynomial = (polynomial + a) * t
    return F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * polynomial


def alphabet(token: Column) -> Column:
    """The symbols of the encoding that ``token`` seems to have; NULL for words and numbers."""
    chosen = F.lit(None).cast("string")
    for pattern, symbols in reversed(ENCODINGS):
        chosen = F.when(F.rlike(token, F.lit(pattern)), F.lit(symbols)).otherwise(chosen)
    return chosen


def p_value(values: Column, n: Column, size: Column) -> Column:
    """The p-value of "the ``n`` symbols are random among ``size``": least of three tests, times three."""
    distinct = F.array_distinct(values)
    squares = F.aggregate(
        distinct,
        F.lit(0.0),
        lambda sum_, v: sum_ + F.pow(F.size(F.filter(values, lambda w: w == v)), F.lit(2)),
    )
    chi = squares * size / n - n
    z_uniform = F.greatest(
        F.lit(0.0), (chi - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
    )
    high = F.transform(values, lambda v: (v >= size / 2).cast("int"))
    after, before = F.slice(high, F.lit(2), F.size(high)), F.slice(high, F.lit(1), F.size(high) - 1)
    runs = 1 + F.size(
        F.filter(F.zip_with(before, after, lambda a, b: a != b), lambda changed: changed)
    )
    ones = F.aggregate(high, F.lit(0), lambda sum_, v: sum_ + v).cast("double")
    product = 2 * ones * (n - ones)
    spread = product * (product - n) / (n * n * (n - 1))
    # a token of one half of the alphabet has no alternation at all
    z_runs = F.when(spread > 0, F.abs(runs - product / n - 1) / F.sqrt(spread)).otherwise(F.lit(8.0))
    mean = F.aggregate(values, F.lit(0.0), lambda sum_, v: sum_ + v) / n
    deviations = F.transform(values, lambda v: v - mean)
    total = F.aggregate(deviations, F.lit(0.0), lambda sum_, d: sum_ + d * d)
    shifted = F.aggregate(
        F.zip_with(
            F.slice(deviations, F.lit(1), F.size(values) - 1),
            F.slice(deviations, F.lit(2), F.size(values)),
            lambda a, b: a * b,
        ),
        F.lit(0.0),
        lambda sum_, d: sum_ + d,
    )
    z_serial = F.when(total > 0, F.abs(shifted / total + 1 / n) * F.sqrt(n)).otherwise(F.lit(8.0))
    least = F.least(normal_tail(z_uniform), 2 * normal_tail(z_runs), 2 * normal_tail(z_serial))
    return F.least(F.lit(1.0), 3 * least)


def rejection_level(tested: DataFrame, false_share: float = FALSE_SHARE) -> float:
    """The largest weighted p-value that is rejected, from the counts in bins of p-values.

    ``tested`` has ``p`` and ``n``, a row per token. A token's weight is its length over the mean length.
    The driver gets one row per bin.
    """
    mean = tested.agg(F.avg("n"), F.count(F.lit(1))).first()
    if not mean[1]:
        return 0.0
    weighted = F.greatest(F.col("p") * mean[0] / F.col("n"), F.lit(1e-300))
    bin_ = F.least(F.floor(-F.log10(weighted) * PER_DECADE), F.lit(BINS)).cast("int")
    counts = dict(map(tuple, tested.groupBy(bin_.alias("bin")).count().collect()))
    level, rejected = 0.0, 0
    for k in sorted(counts, reverse=True):
        rejected += counts[k]
        edge = 10 ** (-k / PER_DECADE)
        if mean[1] * edge <= false_share * rejected:
            level = edge
    return level


def scan_secrets(docs: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """Spans of secrets per row: the fixed forms and the tokens that pass as random, see the module.

    Gives ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_spans`` and ``spans``: arrays of (start,
    kind, end) by start and then kind, code points, end exclusive. A random token within another span
    isn't listed again. NULL text is empty and has none; a NULL ``doc_id`` stays; repeated rows give a row
    each and count as often in the test's level; other columns are ignored; no rows give none.
    """
    tokens = F.filter(
        F.transform(
            matches(F.col("text"), TOKEN),
            lambda m: F.struct(
                m["start"].alias("start"),
                m["end"].alias("end"),
                m["token"].alias("token"),
                alphabet(m["token"]).alias("symbols"),
            ),
        ),
        lambda m: m["symbols"].isNotNull(),
    )

    def tested(m: Column) -> Column:
        values = F.transform(
            F.split(F.translate(m["token"], "-_", "+/"), ""),
            lambda c: F.call_function("instr", m["symbols"], c) - 1,
        )
        n, size = F.length(m["token"]).cast("double"), F.length(m["symbols"]).cast("double")
        return F.struct(
            m["start"].alias("start"), m["end"].alias("end"), p_value(values, n, size).alias("p")
        )

    found = keep(
        texts(docs)
        .select("doc_id", F.array_sort(fixed_forms(F.col("text"))).alias("base"), tokens.alias("tokens"))
        .select("doc_id", "base", F.transform("tokens", tested).alias("tokens")),
        "secrets",
    )
    each = found.select(F.explode("tokens").alias("t")).select(
        "t.p", (F.col("t.end") - F.col("t.start")).alias("n")
    )
    level = rejection_level(each, false_share)
    mean = each.agg(F.coalesce(F.avg("n"), F.lit(1.0))).first()[0]
    passed = F.filter(
        "tokens",
        lambda m: (m["p"] * mean / (m["end"] - m["start"]) > level)
        & ~F.exists(
            "base", lambda b: (b["start"] <= m["start"]) & (b["end"] >= m["end"])
        ),
    )
    random = F.transform(
        passed,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), m["end"].alias("end")
        ),
    )

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda b: b["kind"] == KINDS.index(kind))).cast("long")

    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in KINDS[:3]),
        F.col("base").alias("base_spans"),
        F.array_sort(F.concat("base", random)).alias("spans"),
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]),
        ),
        ",",
    )
