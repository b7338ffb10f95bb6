"""Sets of 64-bit keys that tasks exchange in packed form, a few bytes for each key."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers as compressed byte planes."""
    octets = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(octets.T.tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def pack_sorted(numbers: np.ndarray) -> bytes:
    """Ascending numbers, as differences."""
    return pack(np.diff(numbers, prepend=numbers.dtype.type(0)))


def unpack_sorted(data: bytes, kind: str) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def smallest_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the smallest value of each."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.minimum.reduceat(values, first)


def find(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each wanted key whether it occurs, and where."""
    if not len(sorted_keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return sorted_keys[at] == wanted, at
