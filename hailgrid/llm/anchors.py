"""Removal of repeated passages, found with fixed-block anchors.

A window is ``WINDOW`` (13) consecutive words of a document. A word goes if a window that covers it also
starts in a document with a smaller id; everything is judged on the input.

Every document is cut into non-overlapping blocks of ``BLOCK`` (7) words, the reference blocks. A window
of 2 * 7 - 1 words holds exactly one whole block of its document, so two equal windows meet when the
rolling 7-word windows of one document probe the blocks of the other. Two exchanges do the work:

1. Chunks (sets of documents by a hash of id and text) send the keys of their blocks, with the smallest document, and
   of all their rolling windows, distinct and packed in about two bytes each, to buckets of the key
   space. A bucket answers with the keys that more than one chunk has, and the smallest document that
   has such a block. Keys of one chunk alone need no answer; the chunk compares its documents itself.
2. A hit is extended to all 13-word windows around it, on the probing side and around the block. Only
   these candidates are exchanged, with full keys, and each bucket answers with the smallest document.
   Runs of windows that occur earlier are the maximal repeats.

No pair of documents is ever listed, so a passage in a third of all documents costs each chunk one key per
window. Copies of whole texts are found first by digest and need no candidates. Keys of the first exchange
may collide, which only adds candidates; windows are equal if two independent hashes of together more than
64 bits are.

Rules: a null or empty text has no words. Rows with one id are documents of which none is smaller than the
other. A document without an id is left as it is. Texts are used whole. Extra columns take no part.
The result has one row per input row; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailgrid.llm.arrow import trimmed
from hailgrid.llm.packed import find, pack, pack_sorted, smallest_by, unpack, unpack_sorted
from hailgrid.llm.rolling import mixed, runs, words

WINDOW, BLOCK = 13, 7
#: Chunks for each shuffle partition; a task holds the words of one chunk.
CHUNKS = 2
NONE = np.iinfo(np.int64).max

_MESSAGE = pa.schema([
    ("bucket", pa.int32()), ("chunk", pa.int32()), ("blocks", pa.binary()), ("smallest", pa.binary()),
    ("probes", pa.binary()),
])
_ANSWER = pa.schema([
    ("chunk", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("smallest", pa.binary())
])
_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())
])
_SPANS = pa.schema([("doc_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


class _Chunk:
    """Word hashes of the documents of a chunk. Documents without an id are left out of all arrays."""

    def __init__(self, table: pa.Table, window: int, block: int):
        self.window, self.block = window, block
        self.rows = table
        ids = table.column("doc_id").to_pandas().to_numpy()
        null = np.asarray(table.column("doc_id").is_null())
        hashes, self.counts = words(table.column("text"))
        self.ids = np.where(null, NONE, np.nan_to_num(ids, nan=0).astype(np.int64)) if null.any() else ids.astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.place = np.arange(len(hashes)) - self.starts[self.doc] if len(hashes) else np.zeros(0, np.int64)
        self.hashes = hashes
        self.null = null
        self.marks = np.asarray(table.column("mark").to_pandas())

    def keys(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which a run of ``length`` words of one document begins, and its key."""
        key = mixed(runs(self.hashes, length))
        n = len(key)
        fits = self.place[:n] + length <= self.counts[self.doc[:n]]
        fits &= ~self.null[self.doc[:n]]
        at = np.flatnonzero(fits)
        return at, key[at]


def _split(keys: np.ndarray, buckets: np.ndarray, count: int):
    """Indices of the keys of each bucket, the keys ascending in each."""
    order = np.lexsort((keys, buckets))
    bounds = np.searchsorted(buckets[order], np.arange(count + 1))
    for b in range(count):
        if bounds[b] < bounds[b + 1]:
            yield b, order[bounds[b] : bounds[b + 1]]


def _send(chunk: int, count: int, narrow: bool, blocks, smallest, block_buckets, probes, probe_buckets) -> pa.Table:
    """Messages of a chunk. Block keys count as probes too and are not sent twice."""
    kind = np.uint32 if narrow else np.uint64
    by_bucket = {b: [None, None] for b in range(count)}
    for b, at in _split(blocks, block_buckets, count):
        by_bucket[b][0] = at
    for b, at in _split(probes, probe_buckets, count):
        by_bucket[b][1] = at
    rows = []
    none = np.zeros(0, kind)
    for b, (own, other) in by_bucket.items():
        if own is None and other is None:
            continue
        rows.append({
            "bucket": b, "chunk": chunk,
            "blocks": pack_sorted(blocks[own].astype(kind) if own is not None else none),
            "smallest": pack(smallest[own] if own is not None else np.zeros(0, np.int64)),
            "probes": pack_sorted(probes[other].astype(kind) if other is not None else none),
        })
    return pa.Table.from_pylist(rows, schema=_MESSAGE)


def _answer(narrow: bool, shared_only: bool):
    """The work of a bucket: the smallest document of each block key, told to all chunks that have it."""
    kind = "uint32" if narrow else "uint64"

    @trimmed
    def work(table: pa.Table) -> pa.Table:
        chunks, bucket = table.column("chunk").to_pylist(), table.column("bucket")[0].as_py()
        blocks = [unpack_sorted(x, kind) for x in table.column("blocks").to_pylist()]
        least = [unpack(x, "int64") for x in table.column("smallest").to_pylist()]
        keys, smallest = smallest_by(np.concatenate(blocks), np.concatenate(least))
        own = [find(keys, x)[1] for x in blocks]
        other = []
        for data in table.column("probes").to_pylist():
            hit, at = find(keys, unpack_sorted(data, kind))
            other.append(at[hit])
        holders = np.zeros(len(keys), np.int32)
        for at in [*own, *other]:
            holders[at] += 1
        rows = []
        for chunk, mine, more in zip(chunks, own, other):
            at = np.sort(np.concatenate([mine, more]))
            if shared_only:
                at = at[holders[at] > 1]
            if len(at):
                rows.append({
                    "chunk": chunk, "bucket": bucket, "keys": pack_sorted(keys[at]), "smallest": pack(smallest[at])
                })
        return pa.Table.from_pylist(rows, schema=_ANSWER)

    return work


def _received(answers: pa.Table, narrow: bool) -> tuple[np.ndarray, np.ndarray]:
    """Full keys and smallest documents of all answers; narrow keys carry their bucket on top."""
    keys, least = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for bucket, data, small in zip(*(answers.column(x).to_pylist() for x in ("bucket", "keys", "smallest"))):
        if bucket < 0:
            continue
        got = unpack_sorted(data, "uint32" if narrow else "uint64").astype(np.uint64)
        keys.append(got | np.uint64(bucket) << np.uint64(32) if narrow else got)
        least.append(unpack(small, "int64"))
    keys, least = np.concatenate(keys), np.concatenate(least)
    order = np.argsort(keys, kind="stable")
    return keys[order], least[order]


def _copies(answers: pa.Table) -> np.ndarray:
    """Marks of the documents of the chunk that repeat a smaller one as a whole."""
    found = [np.zeros(0, np.int64)]
    for bucket, small in zip(answers.column("bucket").to_pylist(), answers.column("smallest").to_pylist()):
        if bucket < 0:
            found.append(np.frombuffer(small, ">i8").astype(np.int64))
    return np.unique(np.concatenate(found))


def _narrow(keys: np.ndarray, count: int) -> np.ndarray:
    """The part of a key that is exchanged: bucket, then 32 bits."""
    low = keys & np.uint64(0xFFFFFFFF)
    return low | ((keys >> np.uint64(32)) % np.uint64(count)) << np.uint64(32)


def _block_keys(chunk: _Chunk, count: int):
    at, keys = chunk.keys(chunk.block)
    keys = _narrow(keys, count)
    aligned = chunk.place[at] % chunk.block == 0
    blocks, smallest = smallest_by(keys[aligned], chunk.ids[chunk.doc[at[aligned]]])
    return at, keys, aligned, blocks, smallest


def dealt(docs: DataFrame, chunks: int) -> DataFrame:
    """Rows with their mark, which tells a row from others with its id, and their chunk.

    Chunks are dealt out by the mark, so that rows without an id, or all under one id, spread over them. What is
    exchanged are smallest ids of keys; it doesn't matter which rows share a chunk.
    """
    mark = F.xxhash64("doc_id", "text")
    return docs.withColumns({"chunk": F.pmod(mark, F.lit(chunks)).cast("int"), "mark": mark})


def repeats(
    rows: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, spans: bool = False
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` per document; with ``spans`` the maximal repeats instead."""
    spark = rows.sparkSession
    block = (window + 1) // 2
    count = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = rows.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    chunked = dealt(docs, CHUNKS * count)

    @trimmed
    def ask_blocks(table: pa.Table) -> pa.Table:
        number = table.column("chunk")[0].as_py()
        chunk = _Chunk(table, window, block)
        _, keys, _, blocks, smallest = _block_keys(chunk, count)
        probes = np.setdiff1d(keys, blocks)
        bucket = lambda k: (k >> np.uint64(32)).astype(np.int64)
        low = lambda k: k & np.uint64(0xFFFFFFFF)
        return _send(number, count, True, low(blocks), smallest, bucket(blocks), low(probes), bucket(probes))

    @trimmed
    def ask_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.Table.from_pylist([], schema=_MESSAGE)
        number = table.column("chunk")[0].as_py()
        chunk = _Chunk(table, window, block)
        at, keys, aligned, blocks, smallest = _block_keys(chunk, count)
        shared, least = _received(answers, True)
        ids = chunk.ids[chunk.doc[at]]
        in_shared, where = find(shared, keys)
        in_own, own = find(blocks, keys)
        earliest = np.full(len(keys), NONE)
        earliest[in_own] = smallest[own[in_own]]
        earliest[in_shared] = np.minimum(earliest[in_shared], least[where[in_shared]])
        hit = earliest < ids
        # Blocks that some later document may repeat: those of other chunks, or of a hit in this one.
        wanted, _ = find(np.unique(keys[hit]), keys)
        wanted = aligned & (wanted | in_shared)
        copies, _ = find(_copies(answers), chunk.marks[chunk.doc[at]])
        hit &= ~copies
        wanted &= ~copies
        # Every window around a hit, and every window whose first whole block is wanted.
        total = len(chunk.hashes)
        probing, referred = np.zeros(total, bool), np.zeros(total, bool)
        for offset in range(window - block + 1):
            for flags, some in ((probing, hit), (referred, wanted)):
                begin = at[some] - offset
                ok = (begin >= 0) & (chunk.place[at[some]] >= offset)
                flags[begin[ok]] = True
        starts, full = chunk.keys(window)
        probing, referred = probing[starts], referred[starts]
        used = probing | referred
        starts, full, referred = starts[used], full[used], referred[used]
        spread = _spread(chunk, starts, window, count)
        refs, first = smallest_by(full[referred], chunk.ids[chunk.doc[starts[referred]]])
        every, place = np.unique(full, return_index=True)
        spread = spread[place]
        known, _ = find(refs, every)
        return _send(number, count, False, refs, first, spread[known], every[~known], spread[~known])

    @trimmed
    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.Table.from_pylist([], schema=_SPANS if spans else _RESULT)
        chunk = _Chunk(table, window, block)
        shared, least = _received(answers, False)
        starts, full = chunk.keys(window)
        found, where = find(shared, full)
        starts, where = starts[found], where[found]
        starts = starts[least[where] < chunk.ids[chunk.doc[starts]]]
        whole, _ = find(_copies(answers), chunk.marks)
        whole &= chunk.counts >= window
        edge = np.zeros(len(chunk.hashes) + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + window, -1)
        gone = np.cumsum(edge)[:-1] > 0
        gone |= whole[chunk.doc]
        return _span_rows(chunk, gone) if spans else _kept_rows(chunk, gone)

    texts = chunked.where("doc_id is not null").select("doc_id", F.sha2("text", 256).alias("digest"), "chunk", "mark")
    twins = texts.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    copies = texts.join(twins.where("n > 1").drop("n"), "digest").where("doc_id > first_id")
    # Eight bytes for each copy, gathered by chunk; a chunk has as many as it has documents.
    copies = copies.groupBy("chunk").agg(F.collect_list("mark").alias("marks")).select(
        "chunk", F.lit(-1).alias("bucket"), F.lit(None).cast("binary").alias("keys"),
        F.unhex(F.array_join(F.transform("marks", lambda x: F.lpad(F.hex(x), 16, "0")), "")).alias("smallest"),
    )
    by_chunk = lambda df: df.groupBy("chunk")
    asked = by_chunk(chunked).applyInArrow(ask_blocks, _ddl(_MESSAGE))
    told = asked.groupBy("bucket").applyInArrow(_answer(True, True), _ddl(_ANSWER)).unionByName(copies)
    asked = by_chunk(chunked).cogroup(by_chunk(told)).applyInArrow(ask_windows, _ddl(_MESSAGE))
    told = asked.groupBy("bucket").applyInArrow(_answer(False, False), _ddl(_ANSWER)).unionByName(copies)
    return by_chunk(chunked).cogroup(by_chunk(told)).applyInArrow(remove, _ddl(_SPANS if spans else _RESULT))


def _spread(chunk: _Chunk, starts: np.ndarray, window: int, count: int) -> np.ndarray:
    """The bucket of windows, by a second hash."""
    second = mixed(runs(mixed(chunk.hashes + np.uint64(1)), window, 0xC2B2AE3D27D4EB4F))
    return (second[starts] % np.uint64(count)).astype(np.int64)


def _kept_rows(chunk: _Chunk, gone: np.ndarray) -> pa.Table:
    ids, texts = chunk.rows.column("doc_id"), chunk.rows.column("text")
    removed = np.bincount(chunk.doc[gone], minlength=len(chunk.counts))
    kept = []
    for row in range(chunk.rows.num_rows):
        parts = (texts[row].as_py() or "").encode("utf-8", "surrogatepass").split()
        if removed[row]:
            start = chunk.starts[row]
            stay = np.flatnonzero(~gone[start : start + chunk.counts[row]])
            parts = [parts[i] for i in stay.tolist()]
        kept.append(b" ".join(parts).decode("utf-8", "surrogatepass"))
    return pa.table([ids, pa.array(chunk.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], schema=_RESULT)


def _span_rows(chunk: _Chunk, gone: np.ndarray) -> pa.Table:
    first = gone & ~(np.concatenate([[False], gone[:-1]]) & (chunk.place > 0))
    after = np.concatenate([first[1:] | ~gone[1:] | (chunk.place[1:] == 0), [True]])
    begin, end = np.flatnonzero(first), np.flatnonzero(gone & after)
    ids = chunk.rows.column("doc_id").take(pa.array(chunk.doc[begin]))
    return pa.table([ids.combine_chunks() if hasattr(ids, "combine_chunks") else ids, pa.array(chunk.place[begin], pa.int64()), pa.array(end - begin + 1, pa.int64())], schema=_SPANS)


def digests(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
