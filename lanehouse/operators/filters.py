"""Row selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.operators.aggregates import max_or_zero

# Fixed values
RUN_MARKER = "RunInfo.xml"


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def above_watermark(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows whose key is above the highest key of the target, or above 0 if it is empty.

    The watermark is a scalar subquery, so the comparison reaches the scan of the source.
    """
    return source.where(F.col(key) > max_or_zero(target, key).scalar())


def keep_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.where(F.col(column).startswith(prefix))


def drop_prefixes(df: DataFrame, column: str, prefixes: Sequence[str]) -> DataFrame:
    return df.where(~fn.starts_with_any(column, prefixes))


def keep_any(df: DataFrame, column: str, texts: Sequence[str]) -> DataFrame:
    return df.where(fn.has_any(column, texts))


def keep_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def drop_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def older_or_equal(df: DataFrame, age: str, cutoff: Column) -> DataFrame:
    return df.where(F.col(age) <= cutoff)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """The frame itself; running it fails with ``message`` when it has no row."""
    found = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    checked = found.select(
        F.when(F.col("n") == 0, F.raise_error(F.lit(message))).otherwise(F.lit(True))
    )
    return df.where(checked.scalar())


def require_unique(df: DataFrame, key: str, message: str) -> DataFrame:
    """The frame itself; running it fails with ``message`` and a key that has more than one row."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    some = repeated.agg(F.min(F.col(key).cast("string")).alias("key"), F.count(F.lit(1)).alias("n"))
    text = F.concat(F.lit(f"{message}: "), F.coalesce("key", F.lit("NULL")))
    checked = some.select(F.when(F.col("n") > 0, F.raise_error(text)).otherwise(F.lit(True)))
    return df.where(checked.scalar())


def complete_runs(
    listing: DataFrame, run: str, path: str, member: str = RUN_MARKER
) -> DataFrame:
    """One row per run: whether its listing holds ``member``."""
    present = fn.base_name(path) == member
    return listing.groupBy(run).agg(F.bool_or(present).alias("complete"))


def groups_with_tag(design: DataFrame, tags: str, name: str, value: str) -> DataFrame:
    """Ours: rows whose array of (name, value) tags holds the given pair."""
    return design.where(
        F.exists(tags, lambda tag: (tag["name"] == name) & (tag["value"] == value))
    )


def route(df: DataFrame, **indexes: int) -> DataFrame:
    """Rows of the given index columns, for example ``project_index=1, lane_index=2``."""
    for column, index in indexes.items():
        df = df.where(F.col(column) == index)
    return df


def empty_counts(stats: DataFrame, count: str) -> DataFrame:
    """Ours: rows whose count is missing or zero."""
    return stats.where(F.col(count).isNull() | (F.col(count) == 0))


def required(column: str) -> Column:
    return F.col(column).isNull()


def not_allowed(column: str, values: Sequence) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(list(values))


def not_typed(column: str, type_name: str) -> Column:
    return F.col(column).isNotNull() & F.col(column).try_cast(type_name).isNull()


def violations(df: DataFrame, key: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """Ours: one row per key and broken rule; a rule is a predicate that is true when broken."""
    broken = F.array_compact(
        F.array(*(F.when(predicate, F.lit(name)) for name, predicate in rules.items()))
    )
    return df.select(*key, F.explode(broken).alias("rule"))
