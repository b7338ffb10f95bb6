"""Removal of repeated runs of lines, found as chunks whose borders their content chooses.

A text is cut into chunks of lines: a rolling hash runs over the hashes of ``WINDOW`` lines, and a chunk ends where
it has a local minimum. A border thus depends on the four lines around it and on nothing else, and chunks that no
end of the text touches have two lines at least. A shared passage has the same borders in every text, wherever it
stands. A chunk of two lines or more that occurs before, in a smaller document or further up in the same one, is
removed; its first occurrence stays. Chunks with equal hashes are compared byte by byte with the first occurrence
before anything goes.

The first and the last chunk of a shared passage mix in foreign lines. With ``whole`` the hits are therefore
widened: every window of two lines that no repeated chunk covers, so those of chunks that are the first or the
only ones of their kind and those across borders, is looked up as well, and a line goes if it and a neighbour are
a pair of lines that occurs before, without a line in common. So every run of two lines or more that occurs before
goes in full, and the first occurrence of every line stays. Texts and passages that occur many times cost a row
per chunk; only what is left costs a row per line. ``op9_line_chunks`` and the pipeline ask for that.

Only hashes are grouped over all documents. Texts are dealt out once, by a hash of id and text: the look-up of pairs,
the pieces of first ones, the pieces that are compared with them and the cut are joins in one plan that all read this
exchange. To this end each of them hands all columns to its function, since a column less would make another
exchange. Texts of one line hold no run and are not dealt out. A chunk in a third of all documents is counted before
the shuffle; in the comparison its rows are a skewed join side, which adaptive execution splits.

Rules: a null text stays null and has no lines; an empty one has one empty line. Null ids count as smaller
than all others. Rows with the same id and the same text count as one document, each is returned; rows
with the same id and other texts are ordered by a hash. A chunk whose bytes differ from the first chunk of
its hash stays, whole. Other columns are kept; the columns in ``MADE`` replace any of these names, and inside the
operator they have names of its own. A document that loses all its lines stays with an empty
text. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailgrid.llm.arrow import column, slices, trimmed
from hailgrid.llm.rolling import mixed, runs

#: Lines under the rolling hash.
WINDOW = 2
MADE = ("n_lines", "n_removed")

_FOUND = "doc_id long, mark long, place int, hash long"
_FOUND_SCHEMA = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("place", pa.int32()), ("hash", pa.int64())])
_FLAGS = "array<struct<kind:int,place:int,hash:bigint,is_first:boolean>>"
#: Kinds of flags: a chunk, whose place is its number, or a pair, whose place is its first line.
CHUNK, PAIR = 0, 1
_PIECES = "mark long, kind int, place int, hash long, piece string"
_PIECES_SCHEMA = pa.schema([
    ("mark", pa.int64()), ("kind", pa.int32()), ("place", pa.int32()), ("hash", pa.int64()), ("piece", pa.string()),
])


def _line_hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass"))


def line_hashes(lines: list[str]) -> np.ndarray:
    return np.fromiter((_line_hash(x) for x in lines), np.uint64, len(lines))


def cuts(hashes: np.ndarray) -> list[int]:
    """Where chunks of lines with these hashes end, the end of the text included."""
    rolled = mixed(runs(hashes, WINDOW))  # of lines i and i + 1
    lowest = (rolled[1:-1] < rolled[2:]) & (rolled[1:-1] <= rolled[:-2])
    return [*(np.flatnonzero(lowest) + 1 + WINDOW).tolist(), len(hashes)]


def borders(lines: list[str]) -> list[int]:
    return cuts(line_hashes(lines))


def chunks(text: str) -> list[str]:
    """Chunks of lines; joined by line ends they are the text."""
    lines, start, out = text.split("\n"), 0, []
    for end in borders(lines):
        out.append("\n".join(lines[start:end]))
        start = end
    return out


def _hash(chunk: str) -> int:
    return _line_hash(chunk) - (1 << 63)


@trimmed
def _multi_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out = []
        for one, mark, text in zip(*(column(batch, x) for x in ("doc_id", "mark", "text"))):
            if text is not None and "\n" in text:
                out += [(one, mark, i, _hash(x)) for i, x in enumerate(chunks(text)) if "\n" in x]
        arrays = [pa.array([x[i] for x in out], f.type) for i, f in enumerate(_FOUND_SCHEMA)]
        yield pa.RecordBatch.from_arrays(arrays, schema=_FOUND_SCHEMA)


@trimmed
def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows of two lines that no repeated chunk covers."""
    for batch in slices(batches):
        ids, marks, places, hashes = [], [], [], []
        for one, mark, text, flags in zip(*(column(batch, x) for x in ("doc_id", "mark", "text", "flags"))):
            if text is None or "\n" not in text:
                continue
            each = line_hashes(text.split("\n"))
            left = np.ones(len(each) - 1, bool)
            again = [x["place"] for x in flags or () if not x["is_first"]]
            if again:
                ends = [0, *cuts(each)]
                for place in again:
                    left[ends[place] : ends[place + 1] - 1] = False
            at = np.flatnonzero(left).astype(np.int32)
            ids += [one] * len(at)
            marks += [mark] * len(at)
            places.append(at)
            hashes.append(mixed(runs(each, 2))[left].view(np.int64))
        if ids:
            made = [ids, marks, np.concatenate(places), np.concatenate(hashes)]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(made, _FOUND_SCHEMA)], schema=_FOUND_SCHEMA)


@trimmed
def _flagged_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of every flagged chunk and pair."""
    for batch in slices(batches):
        out = []
        for mark, text, flags in zip(*(column(batch, x) for x in ("mark", "text", "flags"))):
            lines = text.split("\n")
            ends = [0, *borders(lines)]
            for x in flags:
                at = x["place"]
                some = lines[ends[at] : ends[at + 1]] if x["kind"] == CHUNK else lines[at : at + 2]
                out.append((mark, x["kind"], at, x["hash"], "\n".join(some)))
        arrays = [pa.array([x[i] for x in out], f.type) for i, f in enumerate(_PIECES_SCHEMA)]
        yield pa.RecordBatch.from_arrays(arrays, schema=_PIECES_SCHEMA)


def _cut(names: dict[str, str]):
    """``names``: the column of the batch that each column of the result comes from."""

    @trimmed
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, n_lines, removed = [], [], []
            for value, gone in zip(column(batch, "text"), column(batch, "gone")):
                n_lines.append(0 if value is None else value.count("\n") + 1)
                dropped = 0
                if gone:
                    lines = value.split("\n")
                    stay = np.ones(len(lines), bool)
                    ends = [0, *borders(lines)]
                    for x in gone:
                        at = x["place"]
                        first, last = (ends[at], ends[at + 1]) if x["kind"] == CHUNK else (at, at + 2)
                        stay[first:last] = False
                    dropped = int((~stay).sum())
                    value = "\n".join([line for line, keep in zip(lines, stay) if keep])
                removed.append(dropped)
                texts.append(value)
            cut = pa.array(texts, pa.string())
            arrays = [cut if x == "text" else batch.column(batch.schema.get_field_index(x)) for x in names.values()]
            arrays += [pa.array(n_lines, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *MADE])

    return work


_ORDER = ("doc_id", "mark", "place")


def _flags(found: DataFrame, kind: int) -> DataFrame:
    """Per document the chunks or pairs whose hash occurs more than once. First ones are flagged as such."""
    order = F.struct(*_ORDER)
    repeated = found.groupBy("hash").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    both = found.join(repeated, "hash")
    if kind == PAIR:  # a pair that shares a line with the first one is no repeat of it
        own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
        both = both.where(~(own & (F.col("place") == F.col("first.place") + 1)))
    first = order.eqNullSafe(F.col("first")).alias("is_first")
    flags = both.select("mark", F.struct(F.lit(kind).alias("kind"), "place", "hash", first).alias("flag"))
    return flags.groupBy("mark").agg(F.collect_set("flag").cast(_FLAGS).alias("flags"))


def remove(rows: DataFrame, folder: str, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """``rows`` with repeated chunks cut out of ``text``, and how many lines there were and went.

    ``whole``: hits are widened to whole repeated runs, so none of them stays in part. ``folder`` gets the flags of
    chunks; each action on the result does the rest anew.
    """
    spark = rows.sparkSession
    kept = [c for c in rows.columns if c.lower() not in MADE]
    rows = rows.select(*kept).withColumn(text, F.col(text).cast("string"))
    schema = rows.select("*").schema.add("n_lines", "long").add("n_removed", "long")
    names = {c: "text" if c == text else f"kept_{i}" for i, c in enumerate(rows.columns)}
    has_lines = F.coalesce(F.contains(F.col(text), F.lit("\n")), F.lit(False))
    dealt = rows.where(has_lines).select(
        F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(key), F.col(text)).alias("mark"),
        *[F.col(c).alias(name) for c, name in names.items()],
    )

    found = dealt.select("doc_id", "mark", "text").mapInArrow(_multi_line, _FOUND)
    _flags(found, CHUNK).write.mode("overwrite").parquet(folder)
    flags = spark.read.schema(f"mark long, flags {_FLAGS}").parquet(folder)
    if whole:
        # A document's flags are as many as its repeated chunks.
        left = dealt.join(flags, "mark", "left").mapInArrow(_pairs, _FOUND)
        both = flags.unionByName(_flags(left, PAIR))
        flags = both.groupBy("mark").agg(F.flatten(F.collect_list("flags")).alias("flags"))

    def pieces(first: bool) -> DataFrame:
        wanted = flags.withColumn("flags", F.filter("flags", lambda x: x["is_first"] == F.lit(first))).where(F.size("flags") > 0)
        return dealt.join(wanted, "mark").mapInArrow(_flagged_texts, _PIECES)

    # A row that occurs twice has its first chunk twice.
    firsts = pieces(True).select("kind", "hash", F.col("piece").alias("first_piece")).dropDuplicates(["kind", "hash"])
    equal = pieces(False).join(firsts, ["kind", "hash"]).where("piece = first_piece")
    gone = equal.groupBy("mark").agg(F.collect_set(F.struct("kind", "place")).alias("gone"))
    cut = dealt.join(gone, "mark", "left").mapInArrow(_cut(names), schema)
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(1).cast("long")
    alone = rows.where(~has_lines).select("*", n_lines.alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    return cut.union(alone)


def digests(cleaned: DataFrame) -> DataFrame:
    return cleaned.select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("kept_sha256"),
    )
