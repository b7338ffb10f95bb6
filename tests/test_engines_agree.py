"""Every registered query on the smallest data, against its SQL in DuckDB."""

import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle.compare import connect, differences

DATA = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_flagship(spark):
    rows = entry(spark).collect()
    assert len(rows) == 10 and (rows[0]["LocationID"], rows[0]["total_demand"]) == (14, 89)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_missing_values_are_alike_and_differ_from_numbers():
    kinds = [float("nan"), None, pd.NA, pd.NaT]
    for a in kinds:
        assert all(not differences(["x"], [(a,)], ["x"], [(b,)]) for b in kinds)
        assert differences(["x"], [(a,)], ["x"], [(0.0,)]) and differences(["x"], [(7,)], ["x"], [(a,)])
    assert differences(["x"], [([1.0],)], ["x"], [([2.0],)])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, DATA).toPandas()
    expected = duck.sql(ORACLES[name]).df()
    problem = differences(
        list(got.columns),
        got.itertuples(index=False),
        list(expected.columns),
        expected.itertuples(index=False),
    )
    assert not problem
