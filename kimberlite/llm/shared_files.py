"""Files in the folder that driver and executors share, opened without Spark."""

from __future__ import annotations

import os
import shutil
import tempfile
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyarrow import fs


def local_path(path: str) -> str | None:
    """The path itself if the folder is mounted on this machine."""
    parts = urlparse(path)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def write_to(path: str) -> pa.NativeFile:
    place = local_path(path)
    if place is not None:
        files, inner = fs.LocalFileSystem(), place
    else:
        files, inner = fs.FileSystem.from_uri(path)
    files.create_dir(inner.rpartition("/")[0], recursive=True)
    return files.open_output_stream(inner)


def read_from(path: str) -> pa.NativeFile:
    """The memory-mapped file; one in a remote store is copied for this process to map."""
    place = local_path(path)
    if place is not None:
        return pa.memory_map(place)
    files, inner = fs.FileSystem.from_uri(path)
    with tempfile.NamedTemporaryFile(delete=False) as copy, files.open_input_stream(inner) as file:
        shutil.copyfileobj(file, copy)
    mapped = pa.memory_map(copy.name)
    os.unlink(copy.name)  # the map keeps it as long as it is read
    return mapped
