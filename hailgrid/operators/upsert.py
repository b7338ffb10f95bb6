"""Insert-or-update by key as a set operation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_by_key(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
) -> DataFrame:
    """The table after ``updates`` have been merged into ``target``.

    New keys are inserted. For known keys ``update_columns`` are overwritten: all non-key
    columns by default, none for an empty list (insert if absent). Keys must be unique and
    non-null on both sides, as in a table with a primary key; the one join is then free of
    skew. The result is written to a new version or partition, never over its own input.
    """
    values = [name for name in target.columns if name not in keys]
    overwritten = values if update_columns is None else list(update_columns)
    unknown = set(overwritten) - set(values)
    if unknown or set(updates.columns) != set(target.columns):
        raise ValueError(f"updates must have the target's columns; unknown: {sorted(unknown)}")
    old = target.select(*keys, F.struct(*values).alias("old"))
    new = updates.select(*keys, F.struct(*values).alias("new"))

    def pick(name: str):
        first, second = ("new", "old") if name in overwritten else ("old", "new")
        present = F.col(first).isNotNull()
        return F.when(present, F.col(f"{first}.{name}")).otherwise(F.col(f"{second}.{name}"))

    merged = old.join(new, list(keys), "full_outer")
    return merged.select(*keys, *[pick(name).alias(name) for name in values]).select(
        *target.columns
    )


def dedupe_by_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; which of several copies stays is unspecified."""
    return rows.dropDuplicates(list(keys))
