"""Files by path or URI, for code that reads and writes them itself."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import BinaryIO

from pyarrow import fs


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if not re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", path):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def list_files(path: str, recursive: bool = False) -> list[fs.FileInfo]:
    """The file, or the files of a folder by name; hidden ones are left out."""
    system, plain = resolve(path)
    info = system.get_file_info(plain)
    if info.type == fs.FileType.File:
        return [info]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = system.get_file_info(fs.FileSelector(plain, recursive=recursive))
    files = [f for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._"]
    return sorted(files, key=lambda f: f.path)


def read_range(handle: BinaryIO, start: int, end: int, step: int = 1 << 20) -> Iterator[bytes]:
    """The bytes from ``start`` to ``end`` in steps."""
    handle.seek(start)
    while start < end and (data := handle.read(min(step, end - start))):
        start += len(data)
        yield data
