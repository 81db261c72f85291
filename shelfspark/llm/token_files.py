"""Files of bytes below the shared scratch folder, written and read inside tasks.

``pyarrow.fs`` opens the folder by its URI, so it may be a mounted path or a store. A file is written under the name of
its attempt and renamed when whole; a task that runs again gives the same bytes under the same final name.
"""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def make_folder(folder: str) -> None:
    """So that a folder is there even if no task writes a file."""
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)


def write_file(folder: str, name: str, chunks) -> int:
    """Write byte strings one after another; the number of bytes."""
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    attempt, size = f"{base}/.{name}-{uuid.uuid4().hex}", 0
    with fs.open_output_stream(attempt) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    fs.move(attempt, f"{base}/{name}")
    return size


def _uri(path: str) -> str:
    """Hadoop writes local files as ``file:/...``."""
    return "file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path


def read_range(path: str, start: int, length: int) -> bytes:
    fs, at = pafs.FileSystem.from_uri(_uri(path))
    with fs.open_input_file(at) as f:
        return f.read_at(length, start)


def open_file(path: str):
    fs, at = pafs.FileSystem.from_uri(_uri(path))
    return fs.open_input_stream(at)
