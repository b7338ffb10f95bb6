"""Byte-level BPE by backtracking, and decoding by an offset table.

Encoding a piece of ``n`` bytes takes one Aho-Corasick pass, which finds the longest vocabulary entry
starting at each byte, and then a walk over the piece. The walk appends the longest entry that is
*compatible* with the entry before it, tries shorter prefixes of it when it is not, and steps back when
nothing fits; a position that led nowhere is never tried twice, so the walk is linear. Two entries are
compatible if merging by rank would never join bytes across the border between them, which is decided
by undoing their merges from the latest to the earliest. A sequence whose neighbours are all compatible
is the one that merging by rank gives.

Texts are first cut at the added tokens of the tokenizer file, then by the byte-level splitting rule.

Rules: a null text counts as empty and gives no ids. Every row is encoded by itself, so repeated rows
give repeated results; other columns are kept unless a new column has their name, which then replaces
them. A text of any length is encoded whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hailgrid.llm.arrow import column, slices, trimmed
from hailgrid.llm.ranges import fresh

# Fixed value: the splitting rule of byte-level BPE files that say "use_regex".
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Pieces whose ids a Python worker remembers; a full memory starts again.
REMEMBERED = 250_000
#: Border decisions that a Python worker remembers.
BORDERS = 200_000
#: Ids decoded at once.
DECODED_AT_ONCE = 1 << 20


def byte_letters() -> dict[str, int]:
    """Byte-level files write printable Latin-1 as itself and other bytes as letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Bpe:
    """Tables of one tokenizer file. Entries are numbered by rank: 256 bytes, then merges in order."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], byte_letters()
        if spec["normalizer"] is not None or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel":
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        if spec["pre_tokenizer"].get("add_prefix_space") or not spec["pre_tokenizer"].get("use_regex", True):
            raise ValueError(f"{path} splits in a way that is not supported")
        raw = lambda token: bytes(letters[c] for c in token)
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        rank: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        self.left, self.right = list(range(256)), list(range(256))
        self.joined: dict[tuple[int, int], int] = {}
        for a, b in pairs:
            left, right = rank[raw(a)], rank[raw(b)]
            whole = raw(a) + raw(b)
            if whole in rank:
                raise ValueError(f"{path} makes {whole!r} in two ways")
            self.joined[left, right] = rank[whole] = len(self.left)
            self.left.append(left)
            self.right.append(right)
        self.ids = np.zeros(len(rank), np.uint32)
        self.text_of: dict[int, bytes] = {}
        for token, number in vocab.items():
            self.ids[rank[raw(token)]] = number
            self.text_of[number] = raw(token)
        self.sizes = [len(x) for x in rank]
        self.shorter = [
            next((rank[x[:n]] for n in range(len(x) - 1, 0, -1) if x[:n] in rank), -1) for x in rank
        ]
        self.starts = ahocorasick.Automaton()
        for entry, number in rank.items():
            self.starts.add_word(entry[::-1].decode("latin-1"), (len(entry), number))
        self.starts.make_automaton()
        self.borders: dict[tuple[int, int], bool] = {}

        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that are not supported")
        by_length = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if by_length else None
        self.text_of |= {number: content.encode() for content, number in self.added.items()}
        count = max(self.text_of) + 1
        self.offsets = np.zeros(count + 1, np.int64)
        np.cumsum([len(self.text_of.get(i, b"")) for i in range(count)], out=self.offsets[1:])
        self.bytes = np.frombuffer(b"".join(self.text_of.get(i, b"") for i in range(count)), np.uint8)
        self.remembered = _Remembered(self)

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging by rank leaves the border between ``a`` and ``b`` alone."""
        known = self.borders.get((a, b))
        if known is not None:
            return known
        if len(self.borders) >= BORDERS:
            self.borders.clear()
        x, y, before, answer = a, b, len(self.left) + 1, True
        while True:
            made = self.joined.get((x, y))
            if made is not None and made < before:
                answer = False
                break
            if x > y and x >= 256:
                before, x = x, self.right[x]
            elif y >= 256:
                before, y = y + 1, self.left[y]
            else:
                break
        self.borders[a, b] = answer
        return answer

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ranks of the entries that make up ``piece``."""
        n = len(piece)
        longest = [-1] * n
        best = [0] * n
        for end, (size, number) in self.starts.iter(piece[::-1].decode("latin-1")):
            at = n - 1 - end
            if size > best[at]:
                best[at], longest[at] = size, number
        sizes, shorter, compatible = self.sizes, self.shorter, self.compatible
        dead = bytearray(n + 1)
        found: list[int] = []
        at = 0
        entry = longest[0] if n else -1
        while at < n:
            end = at + sizes[entry]
            if not dead[end] and (not found or compatible(found[-1], entry)):
                found.append(entry)
                at = end
                entry = longest[at] if at < n else -1
            elif shorter[entry] >= 0:
                entry = shorter[entry]
            else:
                dead[at] = 1
                entry = found.pop()
                at -= sizes[entry]
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        known = self.remembered
        if len(known) > REMEMBERED:
            known.clear()
        if self.cut is None or not any(x in text for x in self.added):
            return b"".join(map(known.__getitem__, PIECES.findall(text)))
        out = []
        for i, part in enumerate(self.cut.split(text)):
            if i % 2:
                out.append(self.added[part].to_bytes(4, "little"))
            else:
                out.extend(map(known.__getitem__, PIECES.findall(part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are not UTF-8 become replacement characters."""
        numbers, parts = np.frombuffer(ids, "<u4"), []
        for start in range(0, len(numbers), DECODED_AT_ONCE):
            some = numbers[start : start + DECODED_AT_ONCE]
            first = self.offsets[some]
            sizes = self.offsets[some + 1] - first
            ends = np.cumsum(sizes)
            place = np.arange(ends[-1]) + np.repeat(first - (ends - sizes), sizes)
            parts.append(self.bytes[place].tobytes())
        return b"".join(parts).decode("utf-8", "replace")


class _Remembered(dict):
    """Pieces and their ids; a missing piece is encoded."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        ids = self.bpe.ids[self.bpe.encode_piece(piece.encode("utf-8"))].astype("<u4").tobytes()
        self[piece] = ids
        return ids


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    return Bpe(path)


def _added(rows: DataFrame, source: str, path: str, names: tuple[str, ...], make) -> DataFrame:
    """``rows`` with new columns that ``make(bpe, value)`` gives for each value of ``source``."""
    kept = [c for c in rows.columns if c.lower() not in names]
    types = {"ids": "binary", "decoded": "string"}
    # The source goes along under a name of its own, so that a replaced column may be the source.
    own = fresh(kept, "source")
    given = rows.select(*kept, F.col(source).alias(own))
    schema = given.drop(own).schema
    for name in names:
        schema = schema.add(name, types[name])

    @trimmed
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        made_types = [pa.binary() if types[n] == "binary" else pa.string() for n in names]
        for batch in slices(batches):
            made = [make(bpe, value) for value in column(batch, own)]
            arrays = [batch.column(i) for i in range(len(kept))]
            arrays += [pa.array([m[i] for m in made], t) for i, t in enumerate(made_types)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *names])

    return given.mapInArrow(work, schema)


def encode(rows: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``ids``: the ids of ``text`` as packed little-endian unsigned 32-bit integers."""
    return _added(rows, text, path, ("ids",), lambda bpe, value: (bpe.encode(value or ""),))


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded``: the text of packed ids. Null ids decode to an empty text."""
    return _added(rows, ids, path, ("decoded",), lambda bpe, value: (bpe.decode(value or b""),))


def encode_and_decode(rows: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``ids`` and ``decoded`` in one pass over the rows."""

    def both(bpe: Bpe, value: str | None) -> tuple[bytes, str]:
        ids = bpe.encode(value or "")
        return ids, bpe.decode(ids)

    return _added(rows, text, path, ("ids", "decoded"), both)


def digests(encoded: DataFrame, *keep: str) -> DataFrame:
    """Per row of ``encode_and_decode``: how many ids there are, and digests of ids and text."""
    return encoded.select(
        *(keep or ("doc_id",)),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
