"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the smallest of its inner s-mers (by hash) is its first or
its last one. That depends on the k-mer alone, so the same passage gives the same anchors in any text, at
positions that differ by a constant; any stretch of text long enough has some. ``anchors`` gives positions
and hashes; a fingerprint holds the ``KEPT`` smallest distinct anchor hashes, 32 bits each with their size, in
order, and the likeness of two fingerprints estimates the share of anchors that their texts have in common.

``K`` is too long for short texts. A text with fewer than ``FEW`` distinct syncmers of one of the ``SIZES``
has those of the next size in its fingerprint as well, up to ``KEPT`` of each; the last size takes every run of
three. The two highest bits of an entry tell its size. Two fingerprints are compared by the smallest size that both
have, never across sizes.

Rules: a null text counts as empty. An empty text has an empty fingerprint. A text of one or two code points has
the hash of the whole text as its only entry. So equal texts have equal
fingerprints. Fingerprints without a common size have likeness 0. Two empty fingerprints have likeness 1, an empty and another one 0. Rows with one key follow
each other in the order of a text hash; null keys come first. Extra columns take no part. Long texts are
read in pieces of ``PIECE`` code points, none is cut off. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hailgrid.llm.arrow import batch_of, column, slices
from hailgrid.llm.rolling import mixed, runs, smallest

K, S = 24, 8
SHORT = (6, 2)
SIZES = ((K, S), SHORT, (3, 2))
FEW = (16, 8, 0)
WHOLE = len(SIZES)
KEPT = 48
PIECE = 1 << 19


def anchors(text: str, k: int = K, s: int = S) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and 64-bit hashes of the closed syncmers, piece by piece."""
    for start in range(0, max(1, len(text) - k + 1), PIECE):
        part = text[start : start + PIECE + k - 1]
        if len(part) < k:
            return
        letters = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        inner = mixed(runs(letters, s))
        least = smallest(inner, k - s + 1)
        n = len(least)
        at = np.flatnonzero((inner[:n] == least) | (inner[k - s : k - s + n] == least))
        yield at + start, mixed(runs(letters, k)[at])


def _least(text: str, kept: int, k: int, s: int) -> np.ndarray:
    least = np.zeros(0, np.uint32)
    for _, hashes in anchors(text, k, s):
        top = (hashes >> np.uint64(32)).astype(np.uint32)
        if len(top) > 16 * kept:
            top = top[top <= np.partition(top, 8 * kept)[8 * kept]]
            if len(np.unique(top)) < kept:  # many equal ones
                top = (hashes >> np.uint64(32)).astype(np.uint32)
        least = np.unique(np.concatenate([least, top]))[:kept]
    return least


def fingerprint(text: str, kept: int = KEPT) -> bytes:
    """The smallest distinct anchor hashes as big-endian 32-bit integers, the size in the two highest bits."""
    if not text:
        return b""
    parts = []
    for size, ((k, s), few) in enumerate(zip(SIZES, FEW)):
        least = _least(text, kept, k, s)
        parts.append(np.unique(least >> np.uint32(2)) | np.uint32(size << 30))
        if len(least) >= min(few, kept):
            break
    entries = np.concatenate(parts)
    if not len(entries):
        whole = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=4)
        entries = np.array([int.from_bytes(whole.digest(), "big") >> 2 | WHOLE << 30], np.uint32)
    return entries.astype(">u4").tobytes()


def likeness(a: bytes, b: bytes, kept: int = KEPT) -> float:
    """Share of the smallest entries of both together that are in both, of the smallest size that both have."""
    if not a or not b:
        return float(a == b)
    x, y = (np.frombuffer(v, ">u4").astype(np.uint32) for v in (a, b))
    common = np.intersect1d(x >> np.uint32(30), y >> np.uint32(30))
    if not len(common):
        return 0.0
    x, y = (v[v >> np.uint32(30) == common[-1]] for v in (x, y))
    both = np.union1d(x, y)[:kept]
    return float(np.isin(both, np.intersect1d(x, y)).sum() / len(both))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as many first code points of ``following``, or all."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def anchor_rows(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per anchor: key, position in code points, hash."""
    schema = pa.schema([("key", pa.int64()), ("position", pa.int64()), ("hash", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for one, value in zip(column(batch, "key"), column(batch, "text")):
                for at, hashes in anchors(value or ""):
                    yield batch_of(schema, [[one] * len(at), at, hashes.view(np.int64)])

    given = rows.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return given.mapInArrow(work, "key long, position long, hash long").withColumnRenamed("key", key)


_ROWS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
_ENDS = "task int, first_text string, last_key long, last_text string"


def _compared(key: int | None, text: str, print_: bytes, next_text: str, next_print: bytes) -> list:
    changed = edited(text, next_text)
    changed_print = print_ if changed == text else fingerprint(changed)
    return [
        key, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        print_, changed_print, likeness(print_, changed_print), likeness(print_, next_print),
    ]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document of a task but the last, compared with the one after it."""
    last = None
    for batch in slices(batches):
        out = []
        for key, value in zip(column(batch, "key"), column(batch, "text")):
            text = value or ""
            print_ = fingerprint(text)
            if last:
                out.append(_compared(*last, text, print_))
            last = (key, text, print_)
        if out:
            yield batch_of(_SCHEMA, [list(x) for x in zip(*out)])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last document of a task, whose neighbours are in other tasks."""
    first = last = None
    for batch in batches:
        if batch.num_rows:
            first = batch.slice(0, 1) if first is None else first
            last = batch.slice(batch.num_rows - 1)
    if first is not None:
        names = ["task", "first_text", "last_key", "last_text"]
        (task,) = column(last, "task")
        (text,), (key,), (last_text,) = column(first, "text"), column(last, "key"), column(last, "text")
        arrays = [pa.array([x], t) for x, t in ((task, pa.int32()), (text, pa.string()), (key, pa.int64()), (last_text, pa.string()))]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = []
        for key, text, following in zip(*(column(batch, x) for x in ("last_key", "last_text", "following"))):
            text, following = text or "", following or ""
            rows.append(_compared(key, text, fingerprint(text), following, fingerprint(following)))
        yield batch_of(_SCHEMA, [list(x) for x in zip(*rows)])


def compare_neighbours(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of texts and of their edited forms, compared along the order of the key.

    Texts are shuffled once, into ranges of the key, a fixed number of them, so that a range is the same
    task wherever the shuffle is read. A task compares the documents it holds; of each range the last
    document is compared with the first one of the next range, for which the ends of ranges are joined.
    """
    tasks = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    ordered = ordered.repartitionByRange(tasks, "key").sortWithinPartitions("key", F.xxhash64("text"))
    ends = ordered.withColumn("task", F.spark_partition_id()).mapInArrow(_ends, _ENDS)
    order = Window.orderBy("task")  # one number per task
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = ends.select("task", F.coalesce(F.lead("task").over(order), F.min("task").over(whole)).alias("next_task"))
    first = ends.select(F.col("task").alias("next_task"), F.col("first_text").alias("following"))
    pairs = ends.drop("first_text").join(follows, "task").join(first, "next_task")
    borders = pairs.coalesce(tasks // 64 + 1).mapInArrow(_borders, _ROWS)
    return ordered.mapInArrow(_neighbours, _ROWS).unionByName(borders).withColumnRenamed("doc_id", key)


def digests(compared: DataFrame) -> DataFrame:
    hexed = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return compared.withColumns(hexed)
