"""A bounded sample of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sampled_keys(rows: DataFrame, key: str, count: int) -> list:
    """Up to ``count`` distinct keys, those with the smallest hashes; nulls take no part.

    A bound on the hash, from the number of rows, leaves about twice as many keys as wanted before they are
    ordered, so what reaches the driver does not grow with the table. Where one key has many rows the bound
    may leave fewer than ``count``.
    """
    keys = rows.where(F.col(key).isNotNull()).select(key)
    total, place = keys.count(), F.xxhash64(key)
    if total > 2 * count:
        keys = keys.where(place <= -(2**63) + 2**65 * count // total)
    return [row[0] for row in keys.distinct().orderBy(place, key).limit(count).collect()]
