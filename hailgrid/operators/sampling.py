"""A sample that can be drawn again: the same rows on any partitions, after retries, and in other engines.

A row is taken if the hash of the seed, the row and the number of its copy lies below the fraction. Equal rows are
counted first, so their copies are numbered without gathering them; which of them is called the first makes no
difference. A row with very many copies is dealt out in blocks of copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hailgrid.functions.money import DIGITS

#: Copies of a row that one task numbers at once.
COPIES_AT_ONCE = 1 << 16
#: Hexadecimal digits of the hash that are compared.
PLACES = 15


def row_text(rows: DataFrame) -> Column:
    """A row as text: columns in order, a dash for null, fractions in whole ten-thousandths."""
    texts = []
    for name, kind in rows.dtypes:
        value = F.col(f"`{name}`")
        if kind in ("double", "float") or kind.startswith("decimal"):
            value = F.round(value * 10**DIGITS).try_cast("bigint")
        texts.append(F.coalesce(value.cast("string"), F.lit("-")))
    return F.concat_ws("|", *texts)


def threshold(fraction: float) -> str:
    """The smallest hash that is not taken, as hexadecimal digits."""
    if not 0 <= fraction <= 1:
        raise ValueError("the fraction must lie between 0 and 1")
    return f"{round(fraction * 16**PLACES):0{PLACES}x}" if fraction < 1 else "g"


def keyed_sample(rows: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """A sample without replacement; every copy of a row is taken or not by itself."""
    columns = [F.col(f"`{c}`") for c in rows.columns]
    n, block, copy = _free_names(rows.columns)
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(n))
    few = counted.where(F.col(n) <= COPIES_AT_ONCE).withColumn(block, F.lit(0).cast("bigint"))
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(n) - 1) / COPIES_AT_ONCE))
    many = counted.where(F.col(n) > COPIES_AT_ONCE).withColumn(block, F.explode(blocks)).repartition(block, *columns)
    parts = few.unionByName(many)
    last = F.least(F.col(n), (F.col(block) + 1) * COPIES_AT_ONCE)
    copies = parts.withColumn(copy, F.explode(F.sequence(F.col(block) * COPIES_AT_ONCE + 1, last)))
    text = F.concat_ws("|", F.lit(str(seed)), F.col(copy).cast("string"), row_text(rows))
    taken = F.substring(F.sha2(text, 256), 1, PLACES) < F.lit(threshold(fraction))
    return copies.where(taken).select(*columns)


def _free_names(taken: list[str]) -> list[str]:
    """Three names that no column has."""
    lower, tail = {c.lower() for c in taken}, ""
    while any(f"{name}{tail}" in lower for name in ("n", "block", "copy")):
        tail += "_"
    return [f"{name}{tail}" for name in ("n", "block", "copy")]
