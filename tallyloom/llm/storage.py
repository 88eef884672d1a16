"""Files that tasks write to, and read ranges from, in the shared folder.

Every attempt of a task writes a name of its own and only reports it when the file is closed, so a task
that runs again, or twice, never leaves half a file in the list of files that is read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def new_file(folder: str, label: str, suffix: str):
    """A new file in the folder: its URI and the open stream."""
    uri = f"{folder}/{label}-{uuid.uuid4().hex}{suffix}"
    system, path = opened(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return uri, system.open_output_stream(path)


def random_access(uri: str):
    """The file opened for range reads."""
    system, path = opened(uri)
    return system.open_input_file(path)


def read_range(handle, start: int, size: int) -> bytes:
    handle.seek(start)
    got = handle.read(size)
    if len(got) != size:
        raise ValueError(f"{size} bytes wanted at {start}, {len(got)} there")
    return got
