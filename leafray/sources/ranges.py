"""Files of any store that pyarrow reaches, and their byte ranges, for sources whose tasks read parts of files."""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql.datasource import InputPartition


@dataclass
class ByteRange(InputPartition):
    """What begins from byte ``start`` to before byte ``end`` of a file of ``size`` bytes is the task's."""

    path: str
    start: int
    end: int
    size: int


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the place in it."""
    if local := re.match(r"file:/+(.*)", path):
        return pafs.LocalFileSystem(), "/" + local[1]
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def files(path: str) -> list[tuple[str, int]]:
    """Paths and sizes of the file ``path``, or of the files below it; names with a leading dot or underscore are hidden."""
    fs, place = store(path)
    info = fs.get_file_info(place)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(place, recursive=True))
    hidden = lambda f: any(p[:1] in "._" for p in f.path[len(place) :].split("/") if p)
    prefix = path[: len(path) - len(place)] if path.endswith(place) else re.match(r"([a-z0-9]+://[^/]*)?", path)[0]
    return sorted((prefix + f.path, f.size) for f in found if f.is_file and not hidden(f))


def byte_ranges(paths: list[tuple[str, int]], split: int) -> list[ByteRange]:
    """Ranges of about ``split`` bytes; a last part of less than a tenth goes with the one before."""
    out = []
    for path, size in paths:
        n = max(1, -(-(size - split // 10) // split)) if split else 1
        out += [ByteRange(path, i * split, size if i == n - 1 else (i + 1) * split, size) for i in range(n)]
    return out


def opened(path: str):
    """The file, open for reading at any place."""
    fs, place = store(path)
    return fs.open_input_file(place)
