"""The registered queries: every operator over the given tables, with its SQL check."""

from lanehouse.workload import (  # noqa: F401
    capacity,
    collect,
    files,
    monitor,
    retention,
    sheets,
    status,
    sync,
    text,
)
from lanehouse.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
