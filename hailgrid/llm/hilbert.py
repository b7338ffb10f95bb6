"""Shards along a Hilbert curve through several columns, for pruning of files in every one of them.

Each column is cut into ``2**bits`` cells that hold about equally many rows, by exact counts over the whole
table. The cells of a row are a point of a cube, and the point's place on a Hilbert curve is the row's index:
rows next to each other on the curve are close in all columns. The rows, sorted by that index, are cut into runs,
the shards, whose numbers of rows differ by one at most; a shard is written as files of consecutive rows. The
manifest has the range of every column in every file, so a filter on any of the columns leaves few files.

The law is ``rows``: shard s of k holds the rows from position ceil(s n / k) on. Copies of a text, which other
laws would keep together, may lie in two shards.

Rules: a null, and a NaN, has a cell of its own kind (the first, the last). Rows of one index are ordered by the
key (nulls first), then by a hash of the row; full copies are rows of their own. Texts take no part in the order
and are written whole, empty and null ones too. Other columns are kept; columns called ``shard`` or ``slot`` are
replaced. With fewer rows than shards some shards are empty. An empty table gives no files and no rows.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hailgrid.llm.ranges import fresh, numbered, row_mark

#: Cells of a column are 2**BITS.
BITS = 10
#: Rows of a file.
FILE_ROWS = 1_000_000
LAW = "rows"


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of points, given as an array of shape (dimensions, points).

    Skilling's transposition: undo the turns of the cubes from the largest to the smallest, Gray-code, and
    interleave the bits.
    """
    x = np.array(cells, np.uint64)
    if x.ndim != 2 or len(x) * bits > 63:
        raise ValueError("dimensions times bits must be 63 at most")
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        low = bit - one
        for i in range(len(x)):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        flip = np.where((x[-1] & bit) != 0, flip ^ (bit - one), flip)
    x ^= flip
    index = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(len(x)):
            index = (index << one) | ((x[i] >> np.uint64(level)) & one)
    return index.astype(np.int64)


def cell_bounds(rows: DataFrame, column: str, folder: str, bits: int = BITS) -> list[tuple]:
    """The cells of a column in use, each with its smallest value: at most ``2**bits`` pairs, on the driver.

    A value's cell is the share of rows with smaller values, so cells are even except for frequent values.
    """
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    placed = numbered(counts, [], ["value"], folder, "before", weight="n")
    total = F.lit(max(1, counts.agg(F.sum("n")).first()[0] or 1))
    cell = F.floor(F.col("before") * (1 << bits) / total).cast("int")
    found = placed.groupBy(cell.alias("cell")).agg(F.min("value").alias("value"))
    return [(r["value"], r["cell"]) for r in found.orderBy("cell").collect()]


def _order(value) -> tuple:
    return (value != value, value)  # NaN is above all, as in Spark


def indexed(bounds: list[list[tuple]], bits: int = BITS):
    """A function of columns that gives their index on the curve, as Spark column."""
    tables = [([_order(value) for value, _ in one], [cell for _, cell in one]) for one in bounds]

    def cells(values: pa.Array, table: tuple[list, list]) -> np.ndarray:
        smallest, numbers = table
        coded = (values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values).dictionary_encode()
        of_value = [
            numbers[max(0, bisect.bisect_right(smallest, _order(v)) - 1)] if v is not None and numbers else 0
            for v in coded.dictionary.to_pylist()
        ]
        found = np.array([*of_value, 0], np.uint64)  # the last is for nulls
        return found[coded.indices.fill_null(len(of_value)).to_numpy(zero_copy_only=False)]

    @F.arrow_udf(T.LongType())
    def place(*columns: pa.Array) -> pa.Array:
        points = np.stack([cells(values, table) for values, table in zip(columns, tables, strict=True)])
        return pa.array(curve_index(points, bits), pa.int64())

    return place


def write_shards(
    rows: DataFrame, folder: str, columns: list[str], shards: int, key: str = "doc_id",
    bits: int = BITS, file_rows: int = FILE_ROWS,
) -> DataFrame:
    """Write all rows to ``folder/shards`` in the order of the curve; returns the stored manifest of files."""
    spark = rows.sparkSession
    rows = rows.drop(*[c for c in rows.columns if c.lower() in ("shard", "slot")])
    # Only these columns are counted; texts are not read for it.
    bounds = [cell_bounds(rows.select(c), c, f"{folder}/cells-{i}", bits) for i, c in enumerate(columns)]
    index, mark, place = (fresh(rows.columns, name) for name in ("index", "mark", "place"))
    marked = rows.withColumns({index: indexed(bounds, bits)(*columns), mark: row_mark(rows)})
    placed = numbered(marked, [], [index, key, mark], f"{folder}/order", place)
    total = spark.read.parquet(f"{folder}/order").count()
    position = F.col(place)
    shard = F.expr(f"cast(`{place}` * {shards}L div {max(1, total)}L as int)")
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    cut = placed.withColumn("shard", shard).withColumn("slot", position - first).drop(index, mark, place)
    cut = cut.sortWithinPartitions("shard", "slot")
    cut.write.option("maxRecordsPerFile", file_rows).partitionBy("shard").parquet(f"{folder}/shards")
    manifest = _manifest(spark, folder, columns)
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of all shards, with shard and slot."""
    if not spark.read.parquet(f"{folder}/manifest").take(1):
        schema = spark.read.parquet(f"{folder}/order").schema
        kept = [f for f in schema.fields[:-3]]  # the order's own columns come last
        return spark.createDataFrame([], T.StructType([*kept, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())]))
    return spark.read.parquet(f"{folder}/shards").withColumn("shard", F.col("shard").cast("int"))


def _manifest(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    if spark.read.parquet(f"{folder}/order").isEmpty():
        kinds = spark.read.parquet(f"{folder}/order").schema
        fields = "file string, shard int, first_slot long, rows long".split(", ")
        fields += [f"{side}_{c} {kinds[c].dataType.simpleString()}" for c in columns for side in ("low", "high")]
        fields += [f"nulls_{c} long" for c in columns]
        return spark.createDataFrame([], ", ".join(fields))
    stored = spark.read.parquet(f"{folder}/shards").withColumn("file", F.col("_metadata.file_path"))
    return stored.groupBy("file").agg(
        F.first("shard").cast("int").alias("shard"), F.min("slot").alias("first_slot"), F.count("*").alias("rows"),
        *[side(c).alias(f"{name}_{c}") for c in columns for name, side in (("low", F.min), ("high", F.max))],
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns],
    )


def files_for(manifest: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """The files that may hold rows with every named column in its inclusive range; None leaves a side open."""
    kept = manifest
    for name, (low, high) in ranges.items():
        if low is not None:
            kept = kept.where(F.col(f"high_{name}") >= F.lit(low))
        if high is not None:
            kept = kept.where(F.col(f"low_{name}") <= F.lit(high))
    return kept


def read_ranges(spark: SparkSession, folder: str, ranges: dict[str, tuple]) -> DataFrame:
    """Rows in all ranges; only files that may hold some are opened."""
    names = [r["file"] for r in files_for(spark.read.parquet(f"{folder}/manifest"), ranges).select("file").collect()]
    rows = read_shards(spark, folder) if not names else spark.read.option("basePath", f"{folder}/shards").parquet(*names)
    if not names:
        rows = rows.where(F.lit(False))
    for name, (low, high) in ranges.items():
        rows = rows.where(F.col(name).between(low if low is not None else F.col(name), high if high is not None else F.col(name)))
    return rows


def digests(rows: DataFrame) -> DataFrame:
    """Per document of ``read_shards``: its size, its text's CRC-32 (0 without a text), shard and slot."""
    return rows.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit(LAW).alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
