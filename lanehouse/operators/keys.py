"""Joins on keys that may be NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join on equal keys where NULL equals NULL; the keys come from the left side."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = reduce(and_, (left[key].eqNullSafe(renamed[f"_right_{key}"]) for key in keys))
    return left.join(renamed, same, how).drop(*(f"_right_{key}" for key in keys))
