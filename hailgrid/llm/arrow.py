"""Small helpers for functions that work on Arrow batches inside tasks."""

from __future__ import annotations

import ctypes
import functools
import inspect
from collections.abc import Iterator

import pyarrow as pa

#: Text that is turned into Python objects at once.
SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about ``limit`` bytes each; a longer row stays alone."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        step = max(1, int(rows * limit / max(1, batch.nbytes)))
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def column(batch: pa.RecordBatch | pa.Table, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [pa.array(values, field.type) for values, field in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def trim() -> None:
    """Give free memory back to the system. Python workers live on, and later tasks share their executor."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def trimmed(work):
    """A function of a task, after which memory is given back."""
    if inspect.isgeneratorfunction(work):

        @functools.wraps(work)
        def run(*args):
            try:
                yield from work(*args)
            finally:
                trim()
    else:

        @functools.wraps(work)
        def run(*args):
            try:
                return work(*args)
            finally:
                trim()

    run.__signature__ = inspect.signature(work)  # Spark counts the parameters
    return run
