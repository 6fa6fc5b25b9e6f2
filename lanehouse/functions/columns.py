"""Predicates and scalar expressions on columns."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values
TIMESTAMP_SUFFIX = ".000000Z"
DEFAULT_AGE_DAYS = 30
MINIMUM_AGE_DAYS = 1


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- predicates -------------------------------------------------------------------------------


def changed(target: ColumnOrName, source: ColumnOrName) -> Column:
    """True when both values are known and differ; NULL on either side is not a change."""
    return as_column(target) != as_column(source)


def has_text(value: ColumnOrName, text: str) -> Column:
    return as_column(value).contains(text)


def has_any(value: ColumnOrName, texts: Sequence[str]) -> Column:
    return reduce(or_, (has_text(value, text) for text in texts))


def has_word(value: ColumnOrName, word: str) -> Column:
    """True when ``word`` stands in the line with no word character next to it.

    The plain substring test comes first, as it rules out most lines at little cost.
    """
    line = as_column(value)
    return line.contains(word) & line.rlike(rf"(?<!\w){re.escape(word)}(?!\w)")


def row_contains(columns: Sequence[ColumnOrName], text: str) -> Column:
    """True when the comma-joined rendering of the row contains ``text``, in whichever field."""
    return joined(",", *columns).contains(text)


def starts_with_any(value: ColumnOrName, prefixes: Sequence[str]) -> Column:
    return reduce(or_, (as_column(value).startswith(prefix) for prefix in prefixes))


def is_false(value: ColumnOrName) -> Column:
    """True only for FALSE; NULL does not qualify in a filter."""
    return as_column(value) == F.lit(False)


def is_string(value: ColumnOrName) -> Column:
    """True when a variant holds text."""
    return F.schema_of_variant(as_column(value)) == "STRING"


def has_tag(index_group: ColumnOrName, tag: str) -> Column:
    """Ours: the part of an index group label after the first underscore equals ``tag``."""
    return F.coalesce(F.get(F.split(as_column(index_group), "_"), F.lit(1)) == tag, F.lit(False))


# --- time -------------------------------------------------------------------------------------


def normalise_ts(value: ColumnOrName) -> Column:
    """Drop the zero-microsecond UTC suffix and cast to a zone-less timestamp; bad text gives NULL."""
    plain = F.replace(as_column(value), F.lit(TIMESTAMP_SUFFIX), F.lit(""))
    return plain.try_cast("timestamp_ntz")


def age_or_default(
    days: ColumnOrName, default: int = DEFAULT_AGE_DAYS, minimum: int = MINIMUM_AGE_DAYS
) -> Column:
    value = as_column(days)
    return F.when(value.isNull() | (value < minimum), F.lit(default)).otherwise(value)


def cutoff(now: ColumnOrName, days: ColumnOrName) -> Column:
    """``now`` less a number of days."""
    return as_column(now) - F.make_dt_interval(as_column(days))


def date_tag(value: ColumnOrName) -> Column:
    return F.date_format(as_column(value).cast("date"), "yyyyMMdd")


# --- lines of text ----------------------------------------------------------------------------


def text_lines(text: ColumnOrName) -> Column:
    """The lines of a text in order; a final line break ends the last line and adds none."""
    value = as_column(text)
    body = F.when(value.endswith("\n"), F.left(value, F.length(value) - 1)).otherwise(value)
    return F.split(body, "\n")


def field(line: ColumnOrName, position: int) -> Column:
    """Field ``position`` counted from 1; empty text where the line is shorter.

    Runs of blanks separate fields and blanks at the start are skipped. The pattern never steps
    back and reads no further than the field.
    """
    before = rf"^[ \t]*+(?:[^ \t]++[ \t]++){{{position - 1}}}"
    return F.regexp_extract(as_column(line), before + r"([^ \t]++)", 1)


def tokens(line: ColumnOrName, positions: Sequence[int], separator: str = " ") -> Column:
    """Chosen blank-separated fields, joined; a missing field is empty text."""
    return F.concat_ws(separator, *(field(line, position) for position in positions))


def cut_spaces(line: ColumnOrName, positions: Sequence[int]) -> Column:
    """Chosen fields between single spaces.

    Every space separates, so runs of spaces make empty fields. Positions past the end print nothing,
    and a line without any space passes whole.
    """
    value = as_column(line)
    parts = F.split(value, " ", max(positions) + 1)
    chosen = F.concat_ws(" ", *(F.get(parts, F.lit(position - 1)) for position in positions))
    return F.when(value.contains(" "), chosen).otherwise(value)


def joined(separator: str, *columns: ColumnOrName) -> Column:
    """Fields joined with a separator; a NULL field is empty text and keeps its place."""
    return F.concat_ws(
        separator, *(F.coalesce(as_column(c).cast("string"), F.lit("")) for c in columns)
    )


def formatted(pattern: str, *columns: ColumnOrName) -> Column:
    return F.format_string(pattern, *columns)


# --- paths ------------------------------------------------------------------------------------


def base_name(path: ColumnOrName) -> Column:
    """What follows the last slash."""
    return F.element_at(F.split(as_column(path), "/"), -1)


def join_path(*parts: ColumnOrName) -> Column:
    """Path parts joined by one slash; an absolute part starts the path anew."""

    def add(head: Column, tail: Column) -> Column:
        return (
            F.when(tail.startswith("/"), tail)
            .when(head.endswith("/") | (head == ""), F.concat(head, tail))
            .otherwise(F.concat_ws("/", head, tail))
        )

    return reduce(add, (as_column(part) for part in parts))


def stem(path: ColumnOrName) -> Column:
    """Base name of a Python source or byte-code file without its extension."""
    return F.regexp_replace(base_name(path), r"\.pyc?$", "")


# --- JSON, base64, digests --------------------------------------------------------------------


def from_b64(value: ColumnOrName) -> Column:
    """Base64 to text, blanks at both ends removed."""
    return F.regexp_replace(F.unbase64(as_column(value)).cast("string"), r"^\s+|\s+$", "")


def parse_json(value: ColumnOrName, schema: str) -> Column:
    return F.from_json(as_column(value), schema)


def as_json(*columns: ColumnOrName) -> Column:
    return F.to_json(F.struct(*columns))


def input_json(name: ColumnOrName, values: ColumnOrName) -> Column:
    """The input document of one sample: its name and the list of its files."""
    return as_json(
        as_column(name).alias("sample_name"), as_column(values).alias("unmapped_bams")
    )


def content_md5(content: ColumnOrName) -> Column:
    return F.md5(as_column(content).cast("binary"))


def first_or_self(document: ColumnOrName) -> Column:
    """The first element when a variant holds a list, otherwise the variant itself."""
    value = as_column(document)
    is_list = F.schema_of_variant(value).startswith("ARRAY")
    return F.when(is_list, F.try_variant_get(value, "$[0]", "variant")).otherwise(value)


# --- arrays and maps --------------------------------------------------------------------------


def names(entries: ColumnOrName) -> Column:
    """The ``name`` fields of an array of structs."""
    return F.transform(as_column(entries), lambda entry: entry["name"])


def array_length(values: ColumnOrName) -> Column:
    return F.size(as_column(values))


def contains(values: ColumnOrName, value: ColumnOrName) -> Column:
    return F.array_contains(as_column(values), value)


def overlaps(left: ColumnOrName, right: ColumnOrName) -> Column:
    return F.arrays_overlap(as_column(left), as_column(right))


def overlap_size(left: ColumnOrName, right: ColumnOrName) -> Column:
    return F.size(F.array_intersect(as_column(left), as_column(right)))


def same_set(left: ColumnOrName, right: ColumnOrName) -> Column:
    def ordered(values: ColumnOrName) -> Column:
        return F.sort_array(F.array_distinct(as_column(values)))

    return ordered(left) == ordered(right)


def get_or(mapping: ColumnOrName, key: ColumnOrName, default: ColumnOrName) -> Column:
    return F.coalesce(F.try_element_at(as_column(mapping), as_column(key)), as_column(default))


def keep_entries(mapping: ColumnOrName, keys: Sequence[str]) -> Column:
    """The entries of a map of variants whose key is listed and whose value is text."""
    return F.map_filter(
        as_column(mapping), lambda key, value: key.isin(list(keys)) & is_string(value)
    )


def one_to(n: ColumnOrName) -> Column:
    """The whole numbers 1..n; empty for n below 1."""
    value = as_column(n).cast("long")
    return F.when(value >= 1, F.sequence(F.lit(1).cast("long"), value)).otherwise(
        F.array().cast("array<bigint>")
    )


def capped(value: ColumnOrName, cap: int) -> Column:
    return F.least(as_column(value), F.lit(cap))
