"""Quantiles of spans of time from stored summaries, held against the same steps in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailgrid.fixed import MONEY_COLUMNS, PICKUP, UPPER_TAIL_QUANTILES
from hailgrid.operators import rank_summaries as r
from oracle.registry import check


def summaries_sql(source: str, at: str, columns: list[str], unit: str, parts: int) -> str:
    values = " UNION ALL ".join(
        f"""SELECT CAST(date_trunc('{unit}', {at}) AS DATE) AS period, '{name}' AS column_name,
        CAST({name} AS DOUBLE) AS value FROM {source} WHERE {name} IS NOT NULL"""
        for name in columns
    )
    series = "PARTITION BY period, column_name"
    return f"""SELECT period, column_name, value, step,
      through - COALESCE(LAG(through) OVER ({series} ORDER BY value), 0) AS weight
    FROM (SELECT *, GREATEST(1, known // {parts}) AS step FROM (
      SELECT period, column_name, value, n,
        CAST(SUM(n) OVER ({series} ORDER BY value) AS BIGINT) AS through,
        CAST(SUM(n) OVER ({series}) AS BIGINT) AS known
      FROM (SELECT period, column_name, value, COUNT(*) AS n FROM ({values}) AS v GROUP BY ALL) AS c) AS r) AS s
    WHERE through // step > (through - n) // step OR through = known"""


BOUNDS = """SELECT column_name, CAST(SUM(n) AS BIGINT) AS known_rows, CAST(SUM(step - 1) AS BIGINT) AS rank_error
    FROM (SELECT period, column_name, SUM(weight) AS n, MAX(step) AS step FROM summed GROUP BY ALL) AS p GROUP BY ALL"""


def span_sql(summaries: str, levels: list[float]) -> str:
    probabilities = ", ".join(f"CAST({p} AS DOUBLE)" for p in levels)
    return f"""SELECT * FROM (WITH summed AS MATERIALIZED ({summaries}), bounds AS ({BOUNDS}),
    merged AS (SELECT column_name, value, SUM(SUM(weight)) OVER (PARTITION BY column_name ORDER BY value) AS through
      FROM summed GROUP BY column_name, value)
    SELECT column_name, probability, known_rows, rank_error, MIN(value) AS quantile_value
    FROM merged JOIN bounds USING (column_name), (SELECT unnest([{probabilities}]) AS probability) AS levels
    WHERE through >= GREATEST(1, CEIL(probability * known_rows)) GROUP BY ALL) AS answer"""


LEVELS = [0.01, 0.25, 0.5, 0.75, 0.99]
ORDER_PARTS, TRIP_PARTS = 50, 20
PRICES = ["l_extendedprice", "l_quantity"]
PRICE_SUMMARIES = summaries_sql("lineitem", "l_shipdate", PRICES, "month", ORDER_PARTS)
TRIP_SUMMARIES = summaries_sql("clean", PICKUP, MONEY_COLUMNS, "day", TRIP_PARTS)


def price_summaries(rows: DataFrame) -> DataFrame:
    return r.period_summaries(rows, "l_shipdate", {c: F.col(c) for c in PRICES}, "month", ORDER_PARTS)


def stored_prices(t) -> DataFrame:
    """Later years are stored first, one month of them from half of its rows; it is stored again at the end."""
    rows, root = t.table("lineitem"), t.folder("summaries")
    late, month = F.year("l_shipdate") >= 1998, F.date_trunc("month", "l_shipdate") == F.lit("1999-03-01")
    r.store_summaries(price_summaries(rows.where(late & ~(month & (F.col("l_linenumber") > 2)))), root)
    r.store_summaries(price_summaries(rows.where(~late)), root)
    r.store_summaries(price_summaries(rows.where(month)), root, (1999, 3))
    return t.spark.read.parquet(root).drop("year", "month")


@check("day_rank_summaries", TRIP_SUMMARIES)
def _(t):
    return r.period_summaries(t.clean, PICKUP, {c: F.col(c) for c in MONEY_COLUMNS}, "day", TRIP_PARTS)


@check("stored_rank_summaries", PRICE_SUMMARIES)
def _(t):
    return stored_prices(t)


@check("span_quantiles", span_sql(PRICE_SUMMARIES, LEVELS))
def _(t):
    return r.span_quantiles(stored_prices(t), LEVELS)


@check("span_quantiles_trips", span_sql(TRIP_SUMMARIES, UPPER_TAIL_QUANTILES))
def _(t):
    days = r.period_summaries(t.clean, PICKUP, {c: F.col(c) for c in MONEY_COLUMNS}, "day", TRIP_PARTS)
    return r.span_quantiles(days, UPPER_TAIL_QUANTILES)


# The answer in SQL is that of counting all rows: the true number lies between the two stated.
@check(
    "span_rows_upto",
    """SELECT column_name, upto, CAST(COUNT(*) AS BIGINT) AS known_rows, TRUE AS holds FROM (
      SELECT 'l_extendedprice' AS column_name, unnest([10000.0, 40000.0]::DOUBLE[]) AS upto FROM lineitem
      WHERE l_extendedprice IS NOT NULL UNION ALL
      SELECT 'l_quantity', unnest([10000.0, 40000.0]::DOUBLE[]) FROM lineitem WHERE l_quantity IS NOT NULL
    ) AS v GROUP BY ALL""",
)
def _(t):
    rows, limits = t.table("lineitem"), [10000.0, 40000.0]
    true = rows.agg(*[F.count_if(F.col(c) <= x).alias(f"{c}:{x:.0f}") for c in PRICES for x in limits])
    true = true.unpivot([], true.columns, "name", "true_rows").select(
        F.split("name", ":")[0].alias("column_name"), F.split("name", ":")[1].cast("double").alias("upto"), "true_rows"
    )
    given = r.span_rows_upto(price_summaries(rows), limits)
    holds = F.col("true_rows").between(F.col("least_rows"), F.col("most_rows"))
    return given.join(true, ["column_name", "upto"]).select("column_name", "upto", "known_rows", holds.alias("holds"))
