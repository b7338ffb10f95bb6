"""A table with a primary key whose upserts rewrite only the files that hold an updated key.

Rows lie in files ordered by key, and every version lists its files with their least and greatest key and their
number of rows. An upsert goes in three steps, all of them Spark jobs:

1. Updates are cut into at most ``INTERVALS`` ranges of keys. Files that overlap none of them are never opened.
2. Of the others only the key columns are read and joined with the updates: files with a match are *touched*.
3. Touched files are joined with the updates as a whole and written again under new names, new keys along with
   them. All other files belong to the next version as they are.

A version is one commit (``hailgrid.sinks.commits``): readers see it whole, and of two writers that start from the
same version one is refused with ``Conflict``. Files are never changed, so earlier versions stay readable.

Keys are unique and not null, in updates as well; ``ValueError`` otherwise.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailgrid.sinks.commits import commit, history

INTERVALS = 64
ROWS_PER_FILE = 1_000_000
_LOG = "files STRING, columns STRING, touched BIGINT, added BIGINT, kept BIGINT"


class Change(NamedTuple):
    """A new version: files that were replaced, files written, and files that stayed as they were."""

    version: int
    touched: int
    added: int
    kept: int


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], rows_per_file: int = ROWS_PER_FILE):
        if not keys or rows_per_file < 1:
            raise ValueError("a key and at least one row a file are needed")
        self.spark, self.root, self.keys, self.rows_per_file = spark, root.rstrip("/"), list(keys), rows_per_file

    # --- Versions ---------------------------------------------------------------------------

    def versions(self) -> DataFrame:
        return history(self.spark, f"{self.root}/log", _LOG)

    def _version(self, version: int | None = None):
        log = self.versions()
        chosen = log.orderBy(F.desc("version")) if version is None else log.where(F.col("version") == version)
        line = chosen.first()
        if line is None:
            raise RuntimeError(f"{self.root} has no version {version or ''}".rstrip())
        return line

    def files(self, version: int | None = None) -> DataFrame:
        """``name, low, high, row_count`` of the files of a version, the last unless another is named."""
        return self.spark.read.parquet(f"{self.root}/{self._version(version)['files']}")

    def read(self, version: int | None = None) -> DataFrame:
        line = self._version(version)
        return self._rows([r["name"] for r in self.files(line["version"]).select("name").collect()], line)

    def _rows(self, names: list[str], line) -> DataFrame:
        schema = T.StructType.fromDDL(line["columns"])
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/data/{name}" for name in names])

    # --- Writing ----------------------------------------------------------------------------

    def _key(self) -> Column:
        return F.struct(*self.keys)

    def _write(self, rows: DataFrame, count: int) -> DataFrame:
        """Rows in new files ordered by key; the list of these files."""
        folder = uuid.uuid4().hex
        parts = max(1, -(-count // self.rows_per_file))
        ordered = rows.repartitionByRange(parts, *self.keys).sortWithinPartitions(*self.keys)
        ordered.write.parquet(f"{self.root}/data/{folder}")
        written = self.spark.read.schema(rows.schema).parquet(f"{self.root}/data/{folder}")
        name = F.substring_index("_metadata.file_path", "/", -2)
        return written.groupBy(name.alias("name")).agg(
            F.min(self._key()).alias("low"), F.max(self._key()).alias("high"), F.count(F.lit(1)).alias("row_count")
        )

    def _commit(self, base: int, files: DataFrame, columns: str, touched: int, kept: int) -> Change:
        path = f"files/{uuid.uuid4().hex}"
        files.coalesce(1).write.parquet(f"{self.root}/{path}")
        added = self.spark.read.parquet(f"{self.root}/{path}").count() - kept
        record = {"files": path, "columns": columns, "touched": touched, "added": added, "kept": kept}
        return Change(commit(self.spark, f"{self.root}/log", base, record), touched, added, kept)

    def _checked(self, rows: DataFrame) -> int:
        """The number of rows, whose keys must be unique and known."""
        unknown = reduce(Column.__or__, [F.col(c).isNull() for c in self.keys])
        copies = rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("copies"))
        found = copies.agg(F.sum("copies"), F.max("copies"), F.count_if(unknown)).first()
        if (found[1] or 0) > 1 or found[2]:
            raise ValueError(f"keys {self.keys} must be unique and not null")
        return found[0] or 0

    def create(self, rows: DataFrame) -> Change:
        """The first version."""
        files = self._write(rows, self._checked(rows))
        return self._commit(0, files, _ddl(rows.schema), 0, 0)

    def upsert(
        self, updates: DataFrame, update_columns: Sequence[str] | None = None, expected: int | None = None
    ) -> Change:
        """Insert new keys; overwrite ``update_columns`` of known ones: all columns of ``updates`` by default.

        ``updates`` needs the key and may lack other columns: these stay as they are, and are null in new rows.
        With an empty list known keys are left alone and no file is touched. With ``expected`` the change is refused
        unless that is the last version.
        """
        line = self._version(expected)
        schema = T.StructType.fromDDL(line["columns"])
        given = [c for c in updates.columns if c not in self.keys]
        overwritten = given if update_columns is None else list(update_columns)
        if set(overwritten) - set(given) or set(updates.columns) - set(schema.names) or set(self.keys) - set(updates.columns):
            raise ValueError("updates must have the key, the columns to overwrite, and no others than the table")
        updates = updates.select([F.col(c).cast(schema[c].dataType).alias(c) for c in [*self.keys, *given]])
        count, files = self._checked(updates), self.files(line["version"])

        names = [r["name"] for r in self._candidates(files, updates).select("name").collect()]
        candidates = self._rows(names, line).select(
            *self.keys, *([F.substring_index("_metadata.file_path", "/", -2).alias("__file")] if names else [F.lit("").alias("__file")])
        )
        if overwritten:
            old_files = candidates.join(updates.select(*self.keys), self.keys, "left_semi").select("__file").distinct()
            touched = [r["__file"] for r in old_files.collect()]
            changed = updates
        else:
            touched, changed = [], updates.join(candidates, self.keys, "left_anti")
        gone = self.spark.createDataFrame([(n,) for n in touched], "name STRING")
        rest = files.join(gone, "name", "left_anti")
        replaced = files.join(gone, "name", "left_semi").agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]
        merged = _merged(self._rows(touched, line), changed, self.keys, overwritten, given)
        added = self._write(merged, replaced + count)
        total = files.count()
        return self._commit(line["version"], rest.unionByName(added), line["columns"], len(touched), total - len(touched))

    def _candidates(self, files: DataFrame, updates: DataFrame) -> DataFrame:
        """Files whose range of keys overlaps one of the ranges of the updates' keys."""
        dealt = updates.select(*self.keys).repartitionByRange(INTERVALS, *self.keys)
        ranges = dealt.groupBy(F.spark_partition_id().alias("part")).agg(
            F.min(self._key()).alias("from_key"), F.max(self._key()).alias("to_key")
        )
        # Not all pairs of rows: at most INTERVALS rows meet a row per file.
        meets = (F.col("low") <= F.col("to_key")) & (F.col("high") >= F.col("from_key"))
        return files.join(F.broadcast(ranges), meets, "left_semi")

    def compact(self) -> Change:
        """Write files of less than half the wanted rows together anew."""
        line = self._version()
        files = self.files(line["version"])
        small = files.where(F.col("row_count") * 2 < self.rows_per_file)
        names = [r["name"] for r in small.select("name").collect()]
        rows = small.agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]
        rest = files.where(F.col("row_count") * 2 >= self.rows_per_file)
        added = self._write(self._rows(names, line), rows)
        return self._commit(line["version"], rest.unionByName(added), line["columns"], len(names), rest.count())


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _merged(old: DataFrame, new: DataFrame, keys: list[str], overwritten: list[str], given: list[str]) -> DataFrame:
    """Old rows and updates in one table, with the columns of the old one."""
    values = [c for c in old.columns if c not in keys]
    first = old.select(*keys, F.struct(F.lit(True).alias("__known"), *values).alias("__old"))
    second = new.select(*keys, F.struct(F.lit(True).alias("__known"), *given).alias("__new"))

    def value(name: str) -> Column:
        if name not in given:
            return F.col(f"__old.{name}")
        ahead, behind = ("__new", "__old") if name in overwritten else ("__old", "__new")
        return F.when(F.col(ahead).isNotNull(), F.col(f"{ahead}.{name}")).otherwise(F.col(f"{behind}.{name}"))

    both = first.join(second, keys, "full_outer")
    return both.select(*keys, *[value(c).alias(c) for c in values]).select(old.columns)
