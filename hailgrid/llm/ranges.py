"""Positions of rows in a sorted order, without gathering a group in one task.

Rows are sorted by ranges of (group, order) and stored with the number of their place; what comes before a
range is counted per range and group, which are few. A group may hold any share of all rows. Rows that agree
in every order column keep no fixed order among themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fresh(taken: list[str], name: str) -> str:
    """``name``, with underscores behind it until no column is called so."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def row_mark(rows: DataFrame) -> Column:
    """A hash that full copies share; maps, which have no hash, take no part."""
    plain = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*[F.col(f"`{c}`") for c in sorted(plain)])


def numbered(
    rows: DataFrame, group: list[str], order: list[str], folder: str, position: str = "position",
    weight: str | None = None,
) -> DataFrame:
    """Rows, stored in ``folder`` in ascending (group, order), with their position from 0 on in their group.

    With ``weight`` the position is the sum of the weights before the row. Nulls come first, and make a group
    of their own. The result reads what is stored, so positions don't change when a task is repeated.
    """
    spark, keys = rows.sparkSession, [*group, *order]
    place, lane = fresh(rows.columns, "place"), fresh(rows.columns, "lane")
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged.withColumn(place, F.monotonically_increasing_id()).write.parquet(folder)
    # The upper bits of a place are the number of the range.
    stored = spark.read.parquet(folder).withColumn(lane, F.shiftrightunsigned(place, 33))
    amount = F.count("*") if weight is None else F.sum(weight)
    lanes = stored.groupBy(*group, lane).agg(amount.alias("lane_n"), F.min(place).alias("lane_first"))
    before = Window.partitionBy(*group).orderBy(lane).rowsBetween(Window.unboundedPreceding, -1)
    lanes = lanes.withColumn("lane_start", F.coalesce(F.sum("lane_n").over(before), F.lit(0)))
    lanes = lanes.select(
        *[F.col(g).alias(f"lane_{i}") for i, g in enumerate(group)], F.col(lane).alias("lane_of"), "lane_first", "lane_start"
    )
    same = stored[lane] == lanes["lane_of"]
    for i, g in enumerate(group):
        same &= stored[g].eqNullSafe(lanes[f"lane_{i}"])
    # Without groups there is one row per range of the sort.
    joined = stored.join(lanes if group else F.broadcast(lanes), same)
    if weight is None:
        here = F.col(place) - F.col("lane_first")
    else:
        within = Window.partitionBy(*group, lane).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
        here = F.coalesce(F.sum(weight).over(within), F.lit(0))
    return joined.select(*rows.columns, (F.col("lane_start") + here).alias(position))
