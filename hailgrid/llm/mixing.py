"""Mixing sources to target weights: a token budget handed down a tree, then seeded prefixes of leaves.

The tree has one level per key column (domain, language, source). A node may take at most ``max_epochs``
times the tokens below it. From the root down, the budget of a node is divided among its children by
weight; a child whose limit is below its share takes its limit, and what it leaves goes to its siblings
by weight again, until all siblings are full. Only what a whole node cannot take is left to the siblings
of that node, because its own share was limited one level above in the same way. All shares are whole
tokens and add up to what was handed down: shares are rounded down, and the tokens left over go one each to
the first children by name.

This is one window per level, with no iteration: ordered by limit over weight, the full children come
first, and a child is full if its limit is at most its share of what the children before it have left.

A leaf with ``take`` tokens of its ``available`` ones repeats all its rows ``take div available`` times;
of the next epoch it takes the longest prefix that fits the rest. An epoch orders rows by
``md5(seed|epoch|id)``, then id. The prefix is found without sorting a leaf: tokens are summed by leaf and
leading hash digits, and only the bucket in which the prefix ends is ordered.

Rules: null keys form a node named ``(none)``. A node without a weight has weight 1; a child of weight 0
gets nothing. Null or negative token counts count as 0. Repeated rows count as often as they occur, null
ids order as an empty id. Extra columns are kept unless they carry a name in ``MADE``. An empty table gives
no rows. Everything is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Leading hex digits of the order that make a bucket: 4,096 buckets for a leaf.
DIGITS = 3
MADE = ("copies", "prefix_tokens")


def name_of(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit("(none)"))


def weight_of(keys: list[str], weights: dict[str, int]) -> Column:
    """The weight of a node: by its path (``a/b``), else by its own name, else 1."""
    known = {k: int(v) for k, v in weights.items()}
    if not known:
        return F.lit(1).cast("long")
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    found = F.coalesce(F.try_element_at(table, F.concat_ws("/", *keys)), F.try_element_at(table, F.col(keys[-1])))
    return F.coalesce(found, F.lit(1)).cast("long")


def shares(nodes: DataFrame, parents: list[str], key: str) -> DataFrame:
    """Add ``take``: the tokens of ``given`` for each child, from ``weight`` and ``most``."""
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    ratio = F.when(F.col("weight") > 0, F.col("most").cast("double") / F.col("weight").cast("double"))
    order = siblings.orderBy(F.asc_nulls_last("ratio"), key)
    first, last = Window.unboundedPreceding, Window.unboundedFollowing
    rows = nodes.withColumn("ratio", ratio).withColumns({
        "before": F.coalesce(F.sum("most").over(order.rowsBetween(first, -1)), F.lit(0)),
        "onward": F.sum("weight").over(order.rowsBetween(0, last)),
    })
    left = (F.col("given") - F.col("before")).cast("decimal(20,0)")
    full = (F.col("weight") > 0) & (wide("most") * F.col("onward").cast("decimal(18,0)") <= left * F.col("weight").cast("decimal(18,0)"))
    rows = rows.withColumn("full", full)
    rows = rows.withColumns({
        "spent": F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(siblings), F.lit(0)),
        "open": F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(siblings), F.lit(0)),
    })
    rows = rows.withColumn(
        "share",
        F.when(F.col("full"), F.col("most"))
        .when((F.col("open") == 0) | (F.col("weight") == 0), F.lit(0))
        .otherwise(F.expr("cast(given - spent as decimal(20,0)) * cast(weight as decimal(18,0)) div cast(open as decimal(18,0))")),
    )
    takes_part = (~F.col("full")) & (F.col("weight") > 0)
    rest = F.col("given") - F.sum("share").over(siblings)
    place = F.sum(takes_part.cast("long")).over(siblings.orderBy(key).rowsBetween(first, 0))
    extra = (takes_part & (F.col("place") <= F.col("rest"))).cast("long")
    rows = rows.withColumns({"rest": rest, "place": place})
    return rows.withColumn("take", F.col("share") + extra).drop(
        "ratio", "before", "onward", "full", "spent", "open", "share", "rest", "place"
    )


def budget(
    leaves: DataFrame, keys: list[str], weights: dict[str, int], fraction: tuple[int, int], max_epochs: int
) -> DataFrame:
    """``take`` of every leaf, of a budget of ``fraction`` (a ratio of whole numbers) of all tokens."""
    counted = leaves.select(*keys, "available", (F.col("available") * max_epochs).alias("most"))
    over, under = fraction
    above = None
    for depth in range(1, len(keys) + 1):
        path = keys[:depth]
        nodes = counted.groupBy(*path).agg(F.sum("most").alias("most"), F.sum("available").alias("available"))
        nodes = nodes.withColumn("weight", weight_of(path, weights))
        if above is None:
            nodes = nodes.withColumn("given", F.sum("available").over(Window.partitionBy(F.lit(0))))
            nodes = nodes.withColumn("given", F.expr(f"given * {int(over)} div {int(under)}"))
        else:
            nodes = nodes.join(above, path[:-1])
        above = shares(nodes, path[:-1], path[-1])
        above = above.select(*path, F.col("take").alias("given"), "available")
        if depth < len(keys):
            above = above.drop("available")
    return above.withColumnRenamed("given", "take")


def choose(
    rows: DataFrame, keys: list[str], tokens: Column, weights: dict[str, int], fraction: tuple[int, int],
    max_epochs: int = 1, seed: int = 0, row_id: str = "doc_id",
) -> DataFrame:
    """Rows that take part, with ``copies``: how many epochs hold the row."""
    own = [f"__{k}" for k in keys]
    kept = [c for c in rows.columns if c.lower() not in MADE]
    # The row goes along as one value, so its columns may have any names.
    named = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("__row"),
        F.col(row_id).alias("__id"),
        *[name_of(k).alias(o) for k, o in zip(keys, own)],
        F.greatest(F.coalesce(tokens.cast("long"), F.lit(0)), F.lit(0)).alias("__tokens"),
    )
    light = named.drop("__row")
    leaves = light.groupBy(*own).agg(F.sum("__tokens").alias("available"))
    takes = budget(leaves, own, weights, fraction, max_epochs)
    takes = takes.withColumns({
        "__whole": F.expr("if(available > 0, take div available, 0)"),
        "__rest": F.expr("if(available > 0, take % available, 0)"),
    }).drop("take", "available")
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), (F.col("__whole") + 1).cast("string"), F.coalesce(F.col("__id").cast("string"), F.lit(""))))

    def placed(some: DataFrame) -> DataFrame:
        some = some.join(takes, own).withColumn("__order", order)
        return some.withColumn("__bucket", F.substring("__order", 1, DIGITS))

    bucket = [*own, "__bucket"]
    # Dealt out by bucket, or the sums would be made where the join left the rows: a leaf in one task.
    dealt = placed(light).where("__rest > 0").repartition(*bucket)
    sums = dealt.groupBy(*bucket, "__rest").agg(F.sum("__tokens").alias("__sum"))
    running = Window.partitionBy(*own).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__before", F.coalesce(F.sum("__sum").over(running), F.lit(0)))
    sums = sums.where("__before <= __rest").select(
        *bucket, "__before", (F.col("__before") + F.col("__sum") > F.col("__rest")).alias("__cut")
    )
    marked = placed(named).join(sums, bucket, "left")
    certain = marked.where("not coalesce(__cut, false)").withColumn("__in", F.col("__cut").isNotNull() & (F.col("__rest") > 0))
    within = Window.partitionBy(*bucket).orderBy("__order", "__id", "__tokens").rowsBetween(Window.unboundedPreceding, 0)
    edge = marked.where("__cut").withColumn("__in", F.col("__before") + F.sum("__tokens").over(within) <= F.col("__rest"))
    both = certain.unionByName(edge).withColumn("copies", (F.col("__whole") + F.col("__in").cast("long")).cast("long"))
    return both.where("copies > 0").select("__row.*", "copies")


def epochs(chosen: DataFrame) -> DataFrame:
    """One row per copy, numbered by ``epoch`` from 1."""
    return chosen.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
