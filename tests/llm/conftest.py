import pytest

from hailgrid.functions.storage import new_folder
from hailgrid.llm.queries import importable


@pytest.fixture
def folder(spark):
    return new_folder(spark, "test")


@pytest.fixture(autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture
def documents(spark):
    """Rows with nulls, empty and long texts, ties, repeated rows and columns with clashing names."""

    def make(rows):
        # ids, hash and chunk are names that operators use themselves
        schema = "doc_id long, text string, lang string, source string, n_chars long, ids string, hash string, chunk int"
        full = [(i, t, la, s, len(t or ""), "x", "y", 3) for i, t, la, s in rows]
        return spark.createDataFrame(full, schema)

    return make
