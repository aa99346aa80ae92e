"""Files under the shared folder, written and read by tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

import pyarrow.fs as pafs


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def write_whole(root: str, name: str, parts: Iterable[bytes]) -> int:
    """Write a file under a name of its own and rename it when it is whole; returns its bytes.

    A task that runs again, or beside its twin, puts the same bytes in their place.
    """
    fs, folder = filesystem(root)
    temporary, size = f"{folder}/.{name}.{uuid.uuid4().hex}", 0
    with fs.open_output_stream(temporary, compression=None) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    fs.move(temporary, f"{folder}/{name}")
    return size
