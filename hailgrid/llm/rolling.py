"""Vectorised hashes of words and of runs of words or characters."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text hashed at once; a longer row is cut between words.
PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the information of 64-bit numbers over all their bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def runs(x: np.ndarray, length: int, base: int = int(_BASE)) -> np.ndarray:
    """A polynomial over each run of ``length`` numbers, made from runs of powers of two."""
    if len(x) < length:
        return x[:0]
    out, done, power, run, weight = None, 0, 1, x, np.uint64(base)
    with np.errstate(over="ignore"):
        while power <= length:
            if length & power:
                if out is None:
                    out, done = run, power
                else:
                    n = len(x) - done - power + 1
                    out = out[:n] * weight + run[done : done + n]
                    done += power
            run = run[:-power] * weight + run[power:] if len(run) > power else run[:0]
            weight = weight * weight
            power *= 2
    return out


def smallest(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each window of ``width`` numbers."""
    power = 1
    while power * 2 <= width:
        x = np.minimum(x[:-power], x[power:])
        power *= 2
    rest = width - power
    return np.minimum(x[:-rest], x[rest:]) if rest else x


@lru_cache(maxsize=2)
def _letters(fold: bool) -> np.ndarray:
    table = mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
    if fold:
        table[65:91] = table[97:123]
    return table


@lru_cache(maxsize=1)
def _blanks() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    base = int(_BASE) | 1
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        powers = np.full(size + 1, b, np.uint64)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers))
    return out[0], out[1]


def _hash_piece(octets: np.ndarray, breaks: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word; ``breaks`` are positions at which a word cannot go on."""
    blank = _blanks()[octets]
    word = ~blank
    first = word.copy()
    first[1:] &= blank[:-1]
    breaks = breaks[breaks < len(octets)]
    first[breaks] |= word[breaks]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    up, down = _powers(max(PIECE, 1 << int(len(octets)).bit_length()))
    terms = _letters(fold)[octets] * up[: len(octets)]
    terms[blank] = 0
    sums = np.add.reduceat(terms, starts)
    return starts, mixed(sums * down[starts])


def words(texts: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs without blanks) of all texts, and how many words each text has.

    Nulls have none. ``fold`` takes A-Z for a-z.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    octets = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    hashes, counts = [], np.zeros(n, np.int64)
    row = 0
    while row < n:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1)
        for begin, end in _cuts(octets, int(offsets[row]), int(offsets[last])):
            starts, found = _hash_piece(octets[begin:end], offsets[row:last] - begin if last > row + 1 else np.zeros(0, np.int64), fold)
            hashes.append(found)
            if last == row + 1:
                counts[row] += len(found)
            else:
                place = np.searchsorted(starts + begin, offsets[row : last + 1])
                counts[row:last] = np.diff(place)
        row = last
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), counts


def _cuts(octets: np.ndarray, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """Pieces of a long stretch, cut at blanks; a word longer than a piece stays whole."""
    while end - begin > PIECE + (PIECE >> 1):
        at = begin + PIECE
        while at < end and not _blanks()[octets[at]]:
            at += 1
        yield begin, at
        begin = at
    if end > begin:
        yield begin, end
