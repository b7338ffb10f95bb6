"""The list of checks: name, Spark query and, where one exists, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle.inputs import Inputs, inputs
from oracle.plain import DOUBLES, LISTS, TEXTS
from oracle.sql import with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a function from ``Inputs`` to a DataFrame, with the final SELECT of its SQL."""

    def register(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: plain(name, build(inputs(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = with_ctes(plain_sql(name, sql))
        return build

    return register


def plain(name: str, rows: DataFrame) -> DataFrame:
    """Columns that the two clients would hand over as different Python types, made alike."""
    changed = {c: F.col(c).cast("string") for c in TEXTS.get(name, "").split()}
    changed |= {c: F.col(c).cast("double") for c in DOUBLES.get(name, "").split()}
    changed |= {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in LISTS.get(name, "").split()}
    return rows.withColumns(changed) if changed else rows


def plain_sql(name: str, sql: str) -> str:
    changed = [f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in TEXTS.get(name, "").split()]
    changed += [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in DOUBLES.get(name, "").split()]
    changed += [
        f"""array_to_string(CAST("{c}" AS VARCHAR[]), ',') AS "{c}\""""
        for c in LISTS.get(name, "").split()
    ]
    if not changed:
        return sql
    return f"SELECT * REPLACE ({', '.join(changed)}) FROM (\n{sql}\n) AS answer"
