"""Files beside tables: commit records, archives.  Paths are written as Spark writes them."""

from __future__ import annotations

from pyarrow import fs

# Schemes of Hadoop's clients and the names that Arrow has for the same stores.
_SAME = {"s3a": "s3", "s3n": "s3"}


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """The file system that holds a path, and the path inside it."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_SAME.get(scheme, scheme)}:{rest}")
