"""Token ids in shard files: blocks of ids as bit or byte planes, each compressed with Zstandard.

A shard file holds the ids of consecutive documents, in ascending order of their key::

    IDPLANE1 | planes of chunk 0 | planes of chunk 1 | ... | index | size of the index (8 bytes) | IDPLANE1

A chunk is a block of ``BLOCK`` ids (the last one of a file may be shorter). Its ids, as 32-bit integers,
are transposed: plane j holds bit j (or byte j) of every id. Planes are compressed one by one; a plane of
zeros takes no bytes. The index has, for each chunk, its place in the file, its first id and the sizes of
its planes, and for each document its key, first id and number of ids. So a reader fetches any span of
ids from the chunks that cover it (``read_span``). A file ends with the document that fills it.

Rules: a null text counts as empty; with the end id each document has one id at least. Keys may repeat or
be null (nulls come first); every row is a document of its own, and rows of one key keep no fixed order
among themselves. Other columns take no part. An empty table gives no files and no rows.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hailgrid.llm.arrow import column, slices
from hailgrid.llm.files import read_range, unique, write_file

MAGIC = b"IDPLANE1"
#: Ids of a chunk.
BLOCK = 1 << 16
#: Ids after which a file is closed: 16 MB before compression.
FILE_IDS = 4 << 20
LEVEL = 3
#: Letters of words whose ids a Python worker remembers; a full memory starts again.
REMEMBERED_LETTERS = 600_000
#: Letters that the library encodes as one text.
LEARNED_AT_ONCE = 4096
#: Words that are split and lower-cased letter by letter: Latin letters without combining marks.
PLAIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"

MANIFEST = "task int, file int, name string, documents long, ids long, bytes long"
DOCUMENTS = "name string, doc_id long, first long, ids binary"


def _refusal(spec: dict) -> str | None:
    """Why a tokenizer file can't be encoded word by word, or None."""
    parts = lambda x, key: x[key] if x and x.get("type") == "Sequence" else [x] if x else []
    steps = parts(spec["normalizer"], "normalizers")
    blanks = [x for x in steps if x["type"] == "Replace"]
    if sorted(x["type"] for x in steps) != ["Lowercase", "NFC", "Replace"] or blanks[0]["pattern"] != {"Regex": "\\s+"} or blanks[0]["content"] != " ":
        return "its normalizer is not: compose, make runs of white space one blank, lower case"
    cuts = parts(spec["pre_tokenizer"], "pretokenizers")
    if [x["type"] for x in cuts] != ["Split", "ByteLevel"] or cuts[1].get("add_prefix_space") or cuts[1].get("use_regex", True):
        return "it is not split by one pattern and coded by bytes"
    split = cuts[0]
    if split["behavior"] != "Removed" or not split["invert"] or "\\s" in split["pattern"].get("Regex", "\\s").replace("[^\\s", ""):
        return "its pattern may take white space into words"
    model = spec["model"]
    if model["type"] != "BPE" or model.get("end_of_word_suffix") != "</w>" or model.get("dropout") or model.get("ignore_merges"):
        return "it is not BPE with ends of words"
    if any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] or x["content"].split() != [x["content"]] for x in spec["added_tokens"]):
        return "its added tokens look at what stands around them"
    return None


class Words:
    """Ids of texts by a tokenizer that drops blanks, lowers case and never joins words across blanks.

    The distinct words of a slice are encoded by the tokenizers library, and their ids are laid out by offsets.
    Most words are letters with perhaps a full stop or comma behind; their lower-cased letters are remembered,
    and new ones are encoded together as one text, whose ids are divided after each id that ends a word. Files
    with other rules are refused.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use the cores
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            refusal = _refusal(json.load(file))
        if refusal:
            raise ValueError(f"{path} can't be encoded word by word: {refusal}")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.letters: dict[str, bytes] = {}
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[number for token, number in vocab.items() if token.endswith("</w>")]] = True
        self.marks = [self._one(mark) for mark in ("", ".", ",")]

    def _one(self, word: str) -> bytes:
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, new: list[str]) -> None:
        for start in range(0, len(new), LEARNED_AT_ONCE):
            some = new[start : start + LEARNED_AT_ONCE]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(some):
                self.letters.update((word, self._one(word)) for word in some)
                continue
            packed, bounds = ids.tobytes(), (4 * ends).tolist()
            self.letters.update((word, packed[a:b]) for word, a, b in zip(some, [0, *bounds], bounds))

    def _of_words(self, distinct: pa.Array) -> list[bytes]:
        """The ids of distinct words."""
        last = pc.utf8_slice_codeunits(distinct, -1)
        stop, comma = pc.equal(last, "."), pc.equal(last, ",")
        letters = pc.if_else(pc.or_(stop, comma), pc.utf8_slice_codeunits(distinct, 0, -1), distinct)
        plain = pc.match_substring_regex(letters, PLAIN)
        kinds = (pc.cast(stop, pa.int8()).to_numpy() + 2 * pc.cast(comma, pa.int8()).to_numpy())[plain.to_numpy(zero_copy_only=False)]
        coded = pc.utf8_lower(letters.filter(plain)).dictionary_encode()
        lower = coded.dictionary.to_pylist()
        if len(self.letters) > REMEMBERED_LETTERS:
            self.letters.clear()
        self._learn([word for word in lower if word not in self.letters])
        ids = [self.letters[word] for word in lower]
        found = iter([ids[i] + self.marks[kind] for i, kind in zip(coded.indices.to_pylist(), kinds.tolist())])
        other = distinct.filter(pc.invert(plain)).to_pylist()
        rest = iter(self.tokenizer.encode_batch_fast(other, add_special_tokens=False))
        pack = lambda got: struct.pack(f"<{len(got.ids)}I", *got.ids)
        return [next(found) if is_plain else pack(next(rest)) for is_plain in plain.to_pylist()]

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one behind the other, and how many each text has; a null has none."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = split.flatten().dictionary_encode()
        packed = self._of_words(coded.dictionary)
        sizes = np.array([len(x) // 4 for x in packed], np.int64)
        firsts = np.cumsum(sizes) - sizes
        word = coded.indices.to_numpy()
        ends = np.cumsum(sizes[word])
        places = np.repeat(firsts[word] - (ends - sizes[word]), sizes[word])
        places += np.arange(len(places))
        ids = np.frombuffer(b"".join(packed), "<u4")[places]
        bounds = split.offsets.to_numpy()
        return ids, np.diff(np.concatenate([[0], ends])[bounds - bounds[0]])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        ids, counts = self.encode_array(pa.array(texts, pa.string()))
        bounds = np.concatenate([[0], np.cumsum(counts)])
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]


@lru_cache(maxsize=4)
def words(path: str) -> Words:
    return Words(path)


def pack(ids: np.ndarray, kind: str, level: int = LEVEL) -> list[bytes]:
    """Compressed planes of a block."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "bit":
        planes = np.packbits(np.unpackbits(octets, axis=1, bitorder="little").T, axis=1)
    else:
        planes = np.ascontiguousarray(octets.T)
    press = zstandard.ZstdCompressor(level=level)
    return [press.compress(plane.tobytes()) if plane.any() else b"" for plane in planes]


def unpack(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    """The ids of a block of ``n``."""
    width = (n + 7) // 8 if kind == "bit" else n
    press = zstandard.ZstdDecompressor()
    raw = [press.decompress(x, max_output_size=width) if x else bytes(width) for x in planes]
    table = np.frombuffer(b"".join(raw), np.uint8).reshape(len(planes), width)
    if kind == "bit":
        octets = np.packbits(np.unpackbits(table, axis=1, count=n).T, axis=1, bitorder="little")
    else:
        octets = np.ascontiguousarray(table.T)
    return octets.reshape(-1).view("<u4")


def _table(columns: dict) -> bytes:
    table = pa.table(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def shard(keys: list[int | None], documents: list[bytes], kind: str = "byte", block: int = BLOCK) -> bytes:
    """The bytes of a shard file of documents, given as packed ids."""
    counts = np.array([len(x) // 4 for x in documents], np.int64)
    return shard_of(pa.array(keys, pa.int64()), np.frombuffer(b"".join(documents), "<u4"), counts, kind, block)


def shard_of(keys: pa.Array, ids: np.ndarray, counts: np.ndarray, kind: str = "byte", block: int = BLOCK) -> bytes:
    """The bytes of a shard file: documents' keys, their ids one behind the other, and how many each has."""
    body, places, sizes, at = [MAGIC], [], [], len(MAGIC)
    for start in range(0, len(ids), block):
        planes = pack(ids[start : start + block], kind)
        places.append(at)
        sizes.append([len(x) for x in planes])
        body += planes
        at += sum(sizes[-1])
    chunks = _table({
        "place": pa.array(places, pa.int64()),
        "sizes": pa.array(sizes, pa.list_(pa.int32())),
    })
    index = _table({
        "doc_id": keys,
        "first": pa.array(np.cumsum(counts) - counts, pa.int64()),
        "ids": pa.array(counts, pa.int64()),
    })
    head = struct.pack("<cIQQ", kind[1].encode(), block, len(ids), len(chunks))
    tail = zstandard.ZstdCompressor(level=LEVEL).compress(head + chunks + index)
    return b"".join([*body, tail, struct.pack("<Q", len(tail)), MAGIC])


class Shard:
    """A shard file, of which ``fetch(start, size)`` gives bytes; a negative start counts from the end."""

    def __init__(self, fetch):
        foot = fetch(-16, 16)
        if len(foot) != 16 or foot[8:] != MAGIC:
            raise ValueError("not a shard file, or cut short")
        size = struct.unpack("<Q", foot[:8])[0]
        tail = zstandard.ZstdDecompressor().decompress(fetch(-16 - size, size))
        head = struct.calcsize("<cIQQ")
        letter, self.block, self.ids, chunks = struct.unpack("<cIQQ", tail[:head])
        self.kind = {b"i": "bit", b"y": "byte"}[letter]
        read = lambda data: pa.ipc.open_stream(data).read_all()
        self.chunks = read(tail[head : head + chunks]).to_pydict()
        self.documents = read(tail[head + chunks :])
        self.fetch = fetch

    def span(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start`` on; reads only the chunks that hold them."""
        if not 0 <= start <= start + count <= self.ids:
            raise ValueError(f"the file has {self.ids} ids")
        out = []
        for chunk in range(start // self.block, -(-(start + count) // self.block) if count else 0):
            sizes = self.chunks["sizes"][chunk]
            data = self.fetch(self.chunks["place"][chunk], sum(sizes))
            ends = np.cumsum([0, *sizes])
            n = min(self.block, self.ids - chunk * self.block)
            ids = unpack([data[a:b] for a, b in zip(ends, ends[1:])], n, self.kind)
            begin = chunk * self.block
            out.append(ids[max(0, start - begin) : start + count - begin])
        return np.concatenate(out) if out else np.zeros(0, "<u4")


def write_ids(
    rows: DataFrame, folder: str, path: str, end_id: int, key: str = "doc_id", text: str = "text",
    kind: str = "byte", block: int = BLOCK, file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode texts and write shard files to ``folder``; returns their manifest, which is stored there.

    Rows are dealt out by ranges of the key, so file follows file in the order of (task, number).
    """
    ordered = rows.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    ordered = ordered.repartitionByRange("key").sortWithinPartitions("key")
    out_schema = pa.schema([
        ("task", pa.int32()), ("file", pa.int32()), ("name", pa.string()),
        ("documents", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, number = words(path), TaskContext.get().partitionId(), 0
        parts: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        pending = 0

        def close() -> pa.RecordBatch:
            name = unique(f"ids-{task:06d}-{number:04d}", ".idp")
            keys, ids, counts = pa.concat_arrays([x[0] for x in parts]), *(np.concatenate([x[i] for x in parts]) for i in (1, 2))
            data = shard_of(keys, ids, counts, kind, block)
            write_file(folder, name, data)
            row = [task, number, name, len(keys), pending, len(data)]
            return pa.RecordBatch.from_pylist([dict(zip(out_schema.names, row))], schema=out_schema)

        for batch in slices(batches):
            keys = batch.column(0)
            ids, counts = encoder.encode_array(batch.column(1))
            ids = np.insert(ids, np.cumsum(counts), end_id)
            counts = counts + 1
            ends = np.cumsum(counts)
            first = 0
            while first < len(keys):
                done = ends[first - 1] if first else 0
                stop = min(len(keys), int(np.searchsorted(ends, done + file_ids - pending)) + 1)
                parts.append((keys.slice(first, stop - first), ids[done : ends[stop - 1]], counts[first:stop]))
                pending += int(ends[stop - 1] - done)
                first = stop
                if pending >= file_ids:
                    yield close()
                    parts, pending, number = [], 0, number + 1
        if parts:
            yield close()

    store = f"{folder}/manifest"
    ordered.mapInArrow(work, MANIFEST).write.mode("overwrite").parquet(store)
    return rows.sparkSession.read.parquet(store)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of every shard file: file name, key, first id within the file, and packed ids."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.idp").load(folder)
    names = ["name", "doc_id", "first", "ids"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for name, data in zip(column(batch, "name"), column(batch, "content")):
                fetch = lambda at, n, d=data: d[at : at + n] if at >= 0 else d[len(d) + at :][:n]
                one = Shard(fetch)
                ids = one.span(0, one.ids).tobytes()
                for part in one.documents.to_batches(max_chunksize=4096):
                    first, count = part.column("first").to_numpy(), part.column("ids").to_numpy()
                    packed = [ids[4 * a : 4 * (a + n)] for a, n in zip(first, count)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(packed)), part.column("doc_id"), part.column("first"),
                         pa.array(packed, pa.binary())],
                        names=names,
                    )

    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return named.mapInArrow(work, DOCUMENTS)


def read_span(folder: str, name: str, start: int, count: int) -> np.ndarray:
    """Some ids of one file, without reading the rest of it."""
    return Shard(lambda at, n: read_range(folder, name, at, n)).span(start, count)


def file_starts(manifest: DataFrame) -> DataFrame:
    """For each file, how many ids come before it: running totals of tasks, then of a task's files."""
    tasks = manifest.groupBy("task").agg(F.sum("ids").alias("all_ids"))
    before = F.sum("all_ids").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    tasks = tasks.select("task", F.coalesce(before, F.lit(0)).alias("task_start"))
    within = Window.partitionBy("task").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("ids").over(within), F.lit(0))
    return manifest.join(tasks, "task").select("name", (F.col("task_start") + earlier).alias("file_start"))


def digests(documents: DataFrame, manifest: DataFrame) -> DataFrame:
    """Per document of ``read_ids``: ids before it, its ids counted, and their CRC-32."""
    small = documents.select(
        "name", "doc_id", "first",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    return small.join(file_starts(manifest), "name").select(
        "doc_id", (F.col("file_start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )
