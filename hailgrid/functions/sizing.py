"""Choosing a join strategy from a measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame

# The rows that are broadcast hold a few numbers, so a broadcast stays under about 100 MB.
BROADCAST_ROWS = 1_000_000


def within(bound: DataFrame, max_rows: int) -> bool:
    """Whether ``bound`` holds at most ``max_rows`` rows (one narrow counting job)."""
    return max_rows > 0 and bound.count() <= max_rows
