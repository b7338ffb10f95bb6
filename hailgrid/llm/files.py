"""Files that tasks write next to Spark's own: archives and shards in formats Spark has no writer for.

Every attempt of a task writes under names of its own and returns them as rows. The table of those rows,
the manifest, is written by Spark, which keeps the rows of one attempt for each task; files that it
doesn't name are left-overs of lost attempts, and readers skip their rows. A file appears under its name
when it is whole. Folders are those of ``hailgrid.functions.storage``, which all executors reach; any
address that ``pyarrow.fs`` knows (local, HDFS, object stores) will do.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    store, path = fs.FileSystem.from_uri(folder if ":" in folder.split("/")[0] else f"file://{folder}")
    return store, path.rstrip("/")


def unique(stem: str, ending: str) -> str:
    return f"{stem}-{uuid.uuid4().hex[:12]}{ending}"


def write_file(folder: str, name: str, data: bytes) -> None:
    """Put ``data`` into ``folder/name``, a new name, in one step."""
    store, path = _opened(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/.{name}", compression=None) as out:
        out.write(data)
    store.move(f"{path}/.{name}", f"{path}/{name}")


def read_range(folder: str, name: str, start: int, size: int) -> bytes:
    """Bytes of a file; a negative ``start`` counts from its end."""
    store, path = _opened(folder)
    with store.open_input_file(f"{path}/{name}") as file:
        begin = start if start >= 0 else max(0, file.size() + start)
        file.seek(begin)
        return file.read(size)
