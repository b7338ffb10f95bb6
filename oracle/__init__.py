"""Each operator on the driver's tables, next to the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

CASES = ["trips", "demand", "revenue", "profiling", "models", "storage", "summaries"]


def all_checks():
    """The Spark queries and their SQL, by name."""
    for group in CASES:
        import_module(f"oracle.cases_{group}")
    from oracle.registry import ORACLES, QUERIES

    return dict(QUERIES), dict(ORACLES)
