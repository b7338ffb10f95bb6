"""Numbered commits in a folder: compare-and-swap for writers that know nothing of each other.

A commit is one small JSON file named by its number. It is written whole under another name and then put in its
place by an operation that fails if the number is taken: a hard link on local disks, a rename that does not
overwrite elsewhere (atomic on HDFS; on an object store as atomic as its connector makes it). So of two writers
that have read version ``n``, one makes ``n + 1`` and the other gets ``Conflict``, and a reader sees a commit
whole or not at all. All paths go through Hadoop's file systems, as Spark's own do.
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """Another writer has made this commit."""


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    store, where = file_system(spark, path)
    return store.exists(where)


def remove_tree(spark: SparkSession, path: str) -> None:
    store, where = file_system(spark, path)
    store.delete(where, True)


def _put_if_absent(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Create ``folder/name`` with ``text``; False if it exists."""
    store, where = file_system(spark, folder)
    store.mkdirs(where)
    hidden = f".{name}.{uuid.uuid4().hex}"  # readers of the folder skip such names
    if store.getScheme() == "file":
        local = where.toUri().getPath()
        source = os.path.join(local, hidden)
        with open(source, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(source, os.path.join(local, name))
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(source)
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(where, hidden), hadoop.Path(where, name)
    out = store.create(source, False)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(hadoop, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = hadoop.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(source, target, options)
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception.getClass().getName()):
            raise
        store.delete(source, False)
        return False


def commit(spark: SparkSession, folder: str, expected: int, record: dict) -> int:
    """Make the commit after ``expected``; returns its number, or raises ``Conflict``.

    Numbers start at 1; ``expected`` is 0 for an empty log.
    """
    number = expected + 1
    line = json.dumps({"version": number, **record}, default=str)
    if not _put_if_absent(spark, folder, f"{number:012d}.json", line + "\n"):
        raise Conflict(f"version {number} of {folder} has been committed by another writer")
    return number


def history(spark: SparkSession, folder: str, ddl: str) -> DataFrame:
    """All commits, as rows of ``version`` and the columns of ``ddl``."""
    schema = f"version BIGINT, {ddl}"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(folder)


def latest(spark: SparkSession, folder: str) -> int:
    """The number of the last commit; 0 if there is none."""
    return history(spark, folder, "ignored STRING").agg(F.max("version")).first()[0] or 0
