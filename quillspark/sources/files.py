"""Files by path or URI, opened where they are read: local ones directly, others by the file system that the URI names."""

from __future__ import annotations

import os
from typing import IO
from urllib.parse import unquote, urlsplit


def local_path(path: str) -> str | None:
    """The path of a local file, null for one on another file system."""
    if path.startswith("file:"):
        return unquote(urlsplit(path).path)
    return None if "://" in path else path


def _remote(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def opened(path: str) -> IO[bytes]:
    local = local_path(path)
    if local is not None:
        return open(local, "rb")
    system, inner = _remote(path)
    return system.open_input_file(inner)


def created(path: str) -> IO[bytes]:
    """A new file; its folder is made where it is missing."""
    local = local_path(path)
    if local is not None:
        os.makedirs(os.path.dirname(os.path.abspath(local)), exist_ok=True)
        return open(local, "wb")
    system, inner = _remote(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(inner)


def listed(root: str) -> list[tuple[str, int, float]]:
    """(path, bytes, time of change) of all files below `root`, by path, in the form in which `root` is given."""
    local = local_path(root)
    if local is not None:
        head = root[: len(root) - len(local)] if root.endswith(local) else "file:" if root.startswith("file:") else ""
        found = [os.path.join(folder, n) for folder, _, names in os.walk(local) for n in names]
        return sorted((head + p, (s := os.stat(p)).st_size, s.st_mtime) for p in found)
    from pyarrow import fs

    system, inner = _remote(root)
    head = root[: len(root) - len(inner)]
    files = system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted((head + x.path, x.size, x.mtime.timestamp() if x.mtime else 0.0) for x in files if x.is_file)
