"""File access inside tasks, on any file system that Arrow reaches."""

from __future__ import annotations

from pyarrow import fs


def _locate(path: str):
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def open_file(path: str):
    """Random access input file."""
    system, name = _locate(path)
    return system.open_input_file(name)


def exists(path: str) -> bool:
    system, name = _locate(path)
    return system.get_file_info(name).type == fs.FileType.File


def size(path: str) -> int:
    system, name = _locate(path)
    return system.get_file_info(name).size


def read_text(path: str, encoding: str = "utf-8") -> str:
    with open_file(path) as f:
        return f.read().decode(encoding)


def sibling(path: str, extension: str) -> str | None:
    """The file with another extension, in lower or upper case."""
    stem = path.rsplit(".", 1)[0]
    for candidate in (stem + extension, stem + extension.upper()):
        if exists(candidate):
            return candidate
    return None


def read_bytes(path: str, start: int, length: int) -> bytes:
    """``length`` bytes at ``start``; fewer are an error."""
    with open_file(path) as f:
        f.seek(start)
        data = f.read(length)
    if len(data) != length:
        raise OSError(f"Truncated file: {path}")
    return data
