"""Upserts that rewrite the files of updated keys only."""

import pytest
from pyspark.sql import functions as F

from hailgrid.functions.storage import new_folder
from hailgrid.operators.upsert import upsert_by_key
from hailgrid.sinks.commits import Conflict
from hailgrid.sinks.keyed_table import KeyedTable


@pytest.fixture
def table(spark):
    """4,000 rows in about 20 files, with the key (day, zone)."""
    made = KeyedTable(spark, new_folder(spark, "keyed"), ["day", "zone"], rows_per_file=200)
    rows = spark.range(4000).selectExpr("CAST(id DIV 40 AS INT) AS day", "CAST(id % 40 AS INT) AS zone", "id AS demand", "CAST(id AS STRING) AS note")
    made.create(rows)
    return made


def changes(spark, condition):
    return spark.range(4000).where(condition).selectExpr("CAST(id DIV 40 AS INT) AS day", "CAST(id % 40 AS INT) AS zone", "-id AS demand", "'new' AS note")


def same(one, other):
    return one.exceptAll(other.select(one.columns)).count() == other.select(one.columns).exceptAll(one).count() == 0


def test_only_files_with_an_updated_key_are_rewritten(spark, table):
    before, old = table.files().collect(), table.read()
    assert 15 <= len(before) <= 20
    one_day = changes(spark, "id DIV 40 = 50")
    done = table.upsert(one_day)
    holding = [f for f in before if f.low["day"] <= 50 <= f.high["day"]]
    assert done.version == 2 and 1 <= done.touched <= len(holding) <= 3 and done.kept == len(before) - done.touched
    kept = {f.name for f in before} & {r.name for r in table.files().collect()}
    assert len(kept) == done.kept
    assert same(table.read(), upsert_by_key(old, one_day, ["day", "zone"]))
    assert same(table.read(1), old)  # earlier versions stay


def test_two_distant_days_leave_the_files_between_them(spark, table):
    done = table.upsert(changes(spark, "id DIV 40 IN (1, 98)"))
    assert done.touched <= 6 and done.kept >= 10
    names = [r.name for r in table._candidates(table.files(1), changes(spark, "id DIV 40 IN (1, 98)")).collect()]
    assert len(names) <= 6


def test_new_keys_touch_nothing(spark, table):
    more = changes(spark, "id < 40").withColumn("day", F.lit(500)).drop("note")
    done = table.upsert(more)
    assert done.touched == 0 and done.added >= 1
    found = table.read().where("day = 500")
    assert found.count() == 40 and found.where("note is null").count() == 40
    again = table.upsert(changes(spark, "id < 80").withColumn("day", F.expr("IF(zone < 20, 500, 501)")).dropDuplicates(["day", "zone"]), [])
    assert again.touched == 0
    assert table.read().where("day = 500 and note is null").count() == 40 and table.read().count() == 4060


def test_part_of_the_columns(spark, table):
    table.upsert(changes(spark, "id % 7 = 0").drop("note"))
    rows = table.read()
    assert rows.where("demand = -CAST(note AS BIGINT)").count() == len(range(0, 4000, 7)) and rows.where("note is null").count() == 0


def test_one_of_two_writers_is_refused(spark, table):
    table.upsert(changes(spark, "id < 10"), expected=1)
    with pytest.raises(Conflict):
        table.upsert(changes(spark, "id > 3990"), expected=1)
    assert table.read().where("demand < 0").count() == 9 and table.versions().count() == 2


def test_compaction_keeps_rows(spark, table):
    for day in (200, 201, 202):
        table.upsert(changes(spark, "id < 40").withColumn("day", F.lit(day)))
    rows, files = table.read(), table.files().count()
    done = table.compact()
    assert done.touched >= 3 and table.files().count() < files
    assert same(table.read(), rows)


def test_empty_and_bad_input(spark):
    rows = spark.createDataFrame([], "day INT, zone INT, demand BIGINT")
    table = KeyedTable(spark, new_folder(spark, "keyed"), ["day", "zone"])
    with pytest.raises(RuntimeError):
        table.read()
    table.create(rows)
    assert table.read().count() == 0
    one = spark.createDataFrame([(1, 1, 5)], rows.schema)
    table.upsert(rows)
    table.upsert(one)
    assert [tuple(r) for r in table.read().collect()] == [(1, 1, 5)]
    for bad in (one.unionByName(one), one.withColumn("zone", F.lit(None).cast("int")), one.withColumn("other", F.lit(1)), one.drop("zone")):
        with pytest.raises(ValueError):
            table.upsert(bad)
    with pytest.raises(ValueError):
        table.upsert(one, ["zone"])
