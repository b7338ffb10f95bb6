"""Alignment of two tokenizers by coalescing the byte intervals of their tokens.

A is a byte-level BPE file, B a sentencepiece model that writes a space before each text. Both cut the bytes of a
space and the text into intervals. All intervals, of both, are sorted by their starts; a running maximum of the
ends shows where a group of overlapping tokens ends: a group breaks where a start reaches the maximum of the ends
before it. Within a group every A token is linked with every B token.

Counting pairs over the corpus goes in two steps. Tasks align chunks of documents and store, per chunk, its
distinct pairs with the number of its documents that hold them, and, per document, places in that list. Chunks'
pairs are added up by pair and sent back to the chunks that have them, where documents are summed up. Pairs are
reduced within a chunk before they are shuffled, so a pair that all documents hold costs a chunk one row, and no
table of pairs is held by one task. A group with many tokens is reduced to its distinct ids before it is expanded.

Rules: special tokens' strings are plain text. Null and empty texts, and texts that the tokens of A or B don't
spell exactly (B normalises some characters), have no tokens: all counts are 0 and the digest is the empty text.
Every row is a document of its own, repeated rows and rows without a key too. Texts of any length are encoded
whole. Other columns take no part. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hailgrid.llm.arrow import column, slices, trimmed
from hailgrid.llm.bpe import PIECES, byte_letters

#: Text of a chunk; a longer document is a chunk alone.
CHUNK_BYTES = 16 << 20
#: Text whose tokens are sorted at once.
SLICE_BYTES = 1 << 20
#: Links that are expanded at once.
LINKS_AT_ONCE = 1 << 20
#: Groups with more links are reduced to their distinct ids first.
LARGE_GROUP = 256

STORED = "chunk long, keys array<long>, documents array<int>, docs binary, places binary, times binary"
DOCS = pa.schema([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.int64()),
])
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


class Pair:
    """The two tokenizers and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken

        with open(a_path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters, before = spec["model"], byte_letters(), spec["pre_tokenizer"] or {}
        if spec["normalizer"] is not None or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
            raise ValueError(f"{a_path} is not a plain byte-level BPE file")
        spelled = {number: bytes(letters[c] for c in token) for token, number in model["vocab"].items() if all(c in letters for c in token)}
        added = {x["id"]: x["content"].encode() for x in spec["added_tokens"]}
        plain = {raw: number for number, raw in spelled.items() if number not in added}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in merges]
        if any(x >= y for x, y in zip(made, made[1:])):
            raise ValueError(f"{a_path} does not number its merges in order")  # then numbers wouldn't be ranks
        # No special tokens: their strings are plain text.
        self.a = tiktoken.Encoding("a", pat_str=PIECES.pattern, mergeable_ranks=plain, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        count = self.b.get_piece_size()
        b_bytes = [self._piece(i) for i in range(count)]
        a_bytes = [{**spelled, **added}.get(i, b"") for i in range(max([*spelled, *added]) + 1)]
        self.a_bytes, self.b_bytes = (pa.array(x, pa.large_binary()) for x in (a_bytes, b_bytes))
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in xs], np.int64) for xs in (a_bytes, b_bytes))
        self.b_count = count
        # Decimal ids with what follows them: a comma, or the end of a group's side.
        self.numbers = max(len(a_bytes), count)
        self.written = pa.array([f"{i}{end}" for end in ",|;" for i in range(self.numbers)], pa.large_string())

    def _piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        a = [self.a.encode_to_numpy(" " + text).astype(np.int64) for text in texts]
        return a, [np.array(ids, np.int64) for ids in self.b.encode(texts, num_threads=1)]


@lru_cache(maxsize=2)
def pair(a_path: str, b_path: str) -> Pair:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Pair(a_path, b_path)


def _spelled(table: pa.Array, ids: np.ndarray) -> memoryview:
    """The bytes of tokens, or the written numbers, one behind the other."""
    taken = table.take(pa.array(ids))
    data = taken.buffers()[2]
    return memoryview(data).cast("B") if data is not None else memoryview(b"")


def coalesce(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of intervals by start, and for each, in that order, the number of its group."""
    order = np.lexsort((ends, starts))
    reached = np.maximum.accumulate(ends[order])
    group = np.zeros(len(order), np.int64)
    group[1:] = np.cumsum(starts[order][1:] >= reached[:-1])
    return order, group


class Aligned:
    """Documents of a slice: their tokens one behind the other, and the groups that all tokens fall into."""

    def __init__(self, tools: Pair, texts: list[str | None]):
        self.tools, self.total = tools, len(texts)
        rows = [i for i, text in enumerate(texts) if text]
        a, b = tools.encode([texts[i] for i in rows])
        whole = [b" " + texts[i].encode() for i in rows]
        rows, a, b = self._exact(rows, a, b, whole)
        self.rows = np.array(rows, np.int64)
        self.n_a = np.array([len(x) for x in a], np.int64)
        self.n_b = np.array([len(x) for x in b], np.int64)
        none = np.zeros(0, np.int64)
        self.a, self.b = np.concatenate([none, *a]), np.concatenate([none, *b])
        a_ends, b_ends = np.cumsum(tools.a_sizes[self.a]), np.cumsum(tools.b_sizes[self.b])
        ends = np.concatenate([a_ends, b_ends])
        starts = ends - np.concatenate([tools.a_sizes[self.a], tools.b_sizes[self.b]])
        order, group = coalesce(starts, ends)
        of = np.empty(len(order), np.int64)
        of[order] = group
        self.a_group, self.b_group = of[: len(self.a)], of[len(self.a) :]
        self.groups = int(group[-1]) + 1 if len(group) else 0
        self.a_in, self.b_in = (np.bincount(g, minlength=self.groups) for g in (self.a_group, self.b_group))
        # A document begins where a group begins, as its bytes touch those of the document before.
        self.doc_of_a = np.repeat(np.arange(len(self.rows)), self.n_a)
        self.first_group = self.a_group[np.cumsum(self.n_a) - self.n_a]
        self.group_ends = a_ends[np.cumsum(self.a_in) - 1] if self.groups else none

    def _exact(self, rows, a, b, whole):
        """Only documents whose tokens spell them in both tokenizers."""
        tools, none = self.tools, np.zeros(0, np.int64)
        joined = b"".join(whole)
        sizes = [len(x) for x in whole]
        fits = [tools.a_sizes[x].sum() == n == tools.b_sizes[y].sum() for x, y, n in zip(a, b, sizes)]
        a_text = _spelled(tools.a_bytes, np.concatenate([none, *a]))
        if all(fits) and a_text == joined and _spelled(tools.b_bytes, np.concatenate([none, *b])) == joined:
            return rows, a, b
        kept = [
            fit and _spelled(tools.a_bytes, x) == text and _spelled(tools.b_bytes, y) == text
            for fit, x, y, text in zip(fits, a, b, whole)
        ]
        return tuple([x for x, keep in zip(xs, kept) if keep] for xs in (rows, a, b))

    def digests(self) -> list[str]:
        """For each exact document the SHA-256 of its groups as ``a1,a2|b1;a3|b2,b3``."""
        a_ends, b_ends = np.cumsum(self.a_in), np.cumsum(self.b_in)
        a_kind, b_kind = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        a_kind[a_ends - 1], b_kind[b_ends - 1] = 1, 2
        places = np.empty(len(self.a) + len(self.b), np.int64)
        places[np.arange(len(self.a)) + (b_ends - self.b_in)[self.a_group]] = self.a + a_kind * self.tools.numbers
        places[np.arange(len(self.b)) + a_ends[self.b_group]] = self.b + b_kind * self.tools.numbers
        taken = self.tools.written.take(pa.array(places))
        data = memoryview(taken.buffers()[2]) if len(places) else memoryview(b"")
        offsets = np.frombuffer(taken.buffers()[1], np.int64) if len(places) else np.zeros(1, np.int64)
        ends = offsets[np.cumsum(self.n_a + self.n_b)]
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        return [hashlib.sha256(data[x : y - 1]).hexdigest() for x, y in zip(begins.tolist(), ends.tolist())]

    def per_document(self, per_group: np.ndarray) -> np.ndarray:
        """Sums over the groups of each exact document."""
        return np.add.reduceat(per_group, self.first_group) if len(self.first_group) else np.zeros(0, np.int64)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs per exact document: its number, the pair's key, how many links it has there."""
        space = len(self.tools.a_sizes) * self.tools.b_count
        parts = []
        large = self.a_in * self.b_in > LARGE_GROUP
        sides = []
        for ids, group in ((self.a, self.a_group), (self.b, self.b_group)):
            ones, many = ~large[group], large[group]
            weight = np.ones(int(ones.sum()), np.int64)
            side = [(ids[ones], group[ones], weight)]
            if many.any():
                code, times = np.unique(group[many] * self.tools.numbers + ids[many], return_counts=True)
                side.append((code % self.tools.numbers, code // self.tools.numbers, times))
            sides.append(side)
        doc_of_group = np.zeros(self.groups, np.int64)
        doc_of_group[self.a_group] = self.doc_of_a
        for (a, a_group, a_times), (b, b_group, b_times) in zip(*sides):
            b_in = np.bincount(b_group, minlength=self.groups)
            b_first = np.cumsum(b_in) - b_in
            repeat = b_in[a_group]
            reach = np.cumsum(repeat)
            begin = 0
            while begin < len(a):
                base = reach[begin - 1] if begin else 0
                stop = max(begin + 1, int(np.searchsorted(reach, base + LINKS_AT_ONCE, "right")))
                some, g = repeat[begin:stop], a_group[begin:stop]
                inner = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
                which = np.repeat(b_first[g], some) + inner
                key = np.repeat(doc_of_group[g] * space + a[begin:stop] * self.tools.b_count, some) + b[which]
                times = np.repeat(a_times[begin:stop], some) * b_times[which]
                parts.append(_summed(key, times))
                begin = stop
        if not parts:
            none = np.zeros(0, np.int64)
            return none, none, none
        key, times = parts[0] if len(parts) == 1 else _summed(*map(np.concatenate, zip(*parts)))
        return key // space, key % space, times


def _summed(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order with their sums."""
    if not len(key):
        return key, times
    if (times == 1).all():
        key = np.sort(key)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        return key[first], np.diff(np.append(first, len(key)))
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(times[order], first)


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, "<u4").tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data)) as source:
        return np.frombuffer(source.read(), "<u4")


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def store(rows: DataFrame, folder: str, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Align all texts and store chunks of documents in ``folder/chunks``."""
    given = rows.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    names = [part.split()[0] for part in STORED.split(", ")]
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()]

    @trimmed
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, task, number = pair(a_path, b_path), TaskContext.get().partitionId(), 0
        tables: list[pa.Table] = []
        keys: list[np.ndarray] = []
        times: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            all_keys = np.concatenate(keys)
            distinct, places = np.unique(all_keys, return_inverse=True)
            held = np.bincount(places, minlength=len(distinct))
            row = [
                (task << 32) | number, distinct, held, _ipc(pa.concat_tables(tables)), _packed(places),
                _packed(np.concatenate(times)),
            ]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in slices(batches, SLICE_BYTES):
            texts = column(batch, "text")
            found = Aligned(tools, texts)
            doc, pair_keys, pair_times = found.links()
            columns = {name: np.zeros(found.total, np.int64) for name in ("n_a", "n_b", "n_groups", "n_links", "pairs")}
            at = found.rows
            columns["n_a"][at], columns["n_b"][at] = found.n_a, found.n_b
            columns["n_groups"][at] = found.per_document(np.ones(found.groups, np.int64))
            columns["n_links"][at] = found.per_document(found.a_in * found.b_in)
            columns["pairs"][at] = np.bincount(doc, minlength=len(at))
            digests = [""] * found.total
            for i, digest in zip(at.tolist(), found.digests()):
                digests[i] = digest
            values = {"doc_id": batch.column(0), **columns, "groups_sha256": digests}
            tables.append(pa.table([pa.array(values[f.name], f.type) for f in DOCS], schema=DOCS))
            keys.append(pair_keys)
            times.append(pair_times)
            size += batch.nbytes
            if size >= CHUNK_BYTES:
                yield close()
                tables, keys, times, size, number = [], [], [], 0, number + 1
        if tables:
            yield close()

    place = f"{folder}/chunks"
    given.mapInArrow(work, STORED).write.parquet(place)
    return rows.sparkSession.read.parquet(place)


def _held(chunks: DataFrame) -> DataFrame:
    both = F.explode(F.arrays_zip("keys", "documents")).alias("x")
    return chunks.select("chunk", both).select("chunk", F.col("x.keys").alias("key"), F.col("x.documents").alias("n"))


def pair_counts(chunks: DataFrame, b_path: str) -> DataFrame:
    """Every linked pair of ids: how many documents hold it, and whether no other B id has more with its A id."""
    b_count = pair_size(b_path)
    total = _held(chunks).groupBy("key").agg(F.sum("n").alias("documents"))
    total = total.select("key", F.expr(f"key div {b_count}L").alias("a"), (F.col("key") % b_count).alias("b"), "documents")
    # An A id has at most as many partners as B has pieces.
    return total.withColumn("best", F.col("documents") == F.max("documents").over(Window.partitionBy("a")))


@lru_cache(maxsize=4)
def pair_size(b_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


def documents(chunks: DataFrame, b_path: str) -> DataFrame:
    """Per document: tokens, groups, links, links that are the best of their A id, and the sum of their counts."""
    counted = pair_counts(chunks, b_path).select("key", (F.col("documents") * 2 + F.col("best").cast("int")).alias("value"))
    answers = _held(chunks).select("chunk", "key").join(counted, "key")
    # One row per chunk, as long as the chunk's own list of pairs and in its order.
    answers = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("key", "value"))).alias("answers"))
    answers = answers.select("chunk", F.transform("answers", lambda x: x["value"]).alias("values"))
    light = chunks.select("chunk", "docs", "places", "times").join(answers, "chunk", "left")
    names = [part.split()[0] for part in RESULT.split(", ")]

    @trimmed
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}
                table = pa.ipc.open_stream(one["docs"].as_py()).read_all()
                values = one["values"].values
                values = values.to_numpy() if values is not None else np.zeros(0, np.int64)
                places, times = _unpacked(one["places"].as_py()), _unpacked(one["times"].as_py()).astype(np.int64)
                found = values[places]
                ends = np.cumsum(table.column("pairs").to_numpy())
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                totals = {}
                for name, amount in (("n_best", times * (found & 1)), ("count_sum", times * (found >> 1))):
                    running = np.concatenate([[0], np.cumsum(amount)])
                    totals[name] = pa.array(running[ends] - running[begins], pa.int64())
                arrays = [totals.get(name) if name in totals else table.column(name).combine_chunks() for name in names]
                whole = pa.table(arrays, names=names)
                yield from whole.to_batches(max_chunksize=10_000)

    return light.mapInArrow(work, RESULT)


def alignments(rows: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its key, the ids of both tokenizers, and for each group its end in bytes and its numbers of tokens."""
    given = rows.select(F.col(key).cast("long").alias(key), F.col(text).alias("text"))
    schema = f"{key} long, a_ids array<int>, b_ids array<int>, group_ends array<long>, a_in array<int>, b_in array<int>"

    @trimmed
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = pair(a_path, b_path)
        for batch in slices(batches, SLICE_BYTES):
            found = Aligned(tools, column(batch, "text"))
            out = [[[] for _ in range(found.total)] for _ in range(5)]
            a_at, b_at = (np.concatenate([[0], np.cumsum(n)]) for n in (found.n_a, found.n_b))
            first = [*found.first_group.tolist(), found.groups]
            done = 0
            for i, row in enumerate(found.rows.tolist()):
                span = slice(first[i], first[i + 1])
                out[0][row], out[1][row] = found.a[a_at[i] : a_at[i + 1]], found.b[b_at[i] : b_at[i + 1]]
                out[2][row] = found.group_ends[span] - done
                done = found.group_ends[first[i + 1] - 1]
                out[3][row], out[4][row] = found.a_in[span], found.b_in[span]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
            arrays = [batch.column(0), *[pa.array(values, pa.list_(kind)) for values, kind in zip(out, kinds)]]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "a_ids", "b_ids", "group_ends", "a_in", "b_in"])

    return given.mapInArrow(work, schema)
