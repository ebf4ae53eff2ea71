"""First lines of gzip or plain text files, with an early stop.

A Python data source, ``capped_lines``, with one partition per file. A task
inflates its file piece by piece and stops at the cap, so a sample of a few
lines costs a few kilobytes a file, not its whole hour, and damage behind the
cap does no harm. Python sees the capped lines only; parsing and everything
after it stay with Spark's own functions, and so does the uncapped reader.

Files are opened through Arrow's file systems, by URI or local path.
"""

from __future__ import annotations

import fnmatch
import sys
import zlib
from collections.abc import Iterator
from datetime import timezone

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Tasks get this module by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes read, and bytes inflated, at a time.
PIECE = 16 << 10
SCHEMA = "value string, line int, file_path string, file_name string, file_modification_time timestamp"


def _file_system(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(f"file://{uri}" if uri.startswith("/") else uri)


def _matching(pattern: str) -> Iterator[tuple[str, object]]:
    """Files under a path or glob: whole path, Arrow's file info."""
    from pyarrow import fs

    parts = pattern.rstrip("/").split("/")
    fixed = 0
    while fixed < len(parts) and not any(c in parts[fixed] for c in "*?["):
        fixed += 1
    root, globs = "/".join(parts[:fixed]), parts[fixed:]
    system, base = _file_system(root)
    scheme = root[:len(root) - len(base)] if root.endswith(base) else ""
    info = system.get_file_info(base)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(base, recursive=True))
    for f in sorted(found, key=lambda f: f.path):
        rest = f.path[len(base):].strip("/").split("/") if f.path != base else []
        hidden = any(p.startswith(".") or (p.startswith("_") and "=" not in p) for p in rest)
        fits = not globs or (len(rest) == len(globs) and all(fnmatch.fnmatchcase(r, g) for r, g in zip(rest, globs)))
        if f.type == fs.FileType.File and fits and not hidden:
            yield scheme + f.path, f


def _texts(stream, compressed: bool) -> Iterator[bytes]:
    """The file's text in bounded parts; a gzip file may have several members."""
    inflate, inside = None, False
    while piece := stream.read(PIECE):
        if not compressed:
            yield piece
            continue
        while piece:
            inflate = inflate or zlib.decompressobj(zlib.MAX_WBITS | 16)
            yield inflate.decompress(piece, PIECE)
            inside = not inflate.eof
            piece = inflate.unconsumed_tail if inside else inflate.unused_data
            inflate = inflate if inside else None
    if inside:
        raise EOFError("the file ends inside its compressed data")


def first_lines_of(stream, limit: int, compressed: bool) -> Iterator[bytes]:
    """The first ``limit`` non-blank lines of an open file, read no further than needed."""
    held, left = b"", limit
    for text in _texts(stream, compressed):
        *lines, held = (held + text).split(b"\n")
        for line in lines:
            if left and line.strip():
                yield line.rstrip(b"\r")
                left -= 1
        if not left:
            return
    if left and held.strip():
        yield held.rstrip(b"\r")


class OneFile(InputPartition):
    def __init__(self, path: str, modified):
        self.path, self.modified = path, modified


class CappedLinesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.limit = options["path"].split("\n"), int(options["lines"])

    def partitions(self) -> list[InputPartition]:
        files = [OneFile(path, f.mtime.astimezone(timezone.utc)) for p in self.paths for path, f in _matching(p)]
        return files or [OneFile("", None)]

    def read(self, partition: OneFile):
        if not partition.path:
            return
        system, path = _file_system(partition.path)
        with system.open_input_file(path) as stream:
            lines = first_lines_of(stream, self.limit, path.endswith(".gz"))
            for number, line in enumerate(lines):
                yield (line.decode("utf-8", "replace"), number, partition.path, path.rsplit("/", 1)[-1], partition.modified)


class CappedLines(DataSource):
    """``spark.read.format("capped_lines").option("path", ...).option("lines", n)``."""

    @classmethod
    def name(cls) -> str:
        return "capped_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CappedLinesReader:
        return CappedLinesReader(self.options)


def read_capped_lines(spark: SparkSession, paths: str | list[str], limit: int) -> DataFrame:
    """``value, line, file_path, file_name, file_modification_time``: the first
    ``limit`` non-blank lines of every file under ``paths`` (paths or globs)."""
    spark.dataSource.register(CappedLines)
    listed = "\n".join([paths] if isinstance(paths, str) else paths)
    return spark.read.format("capped_lines").option("path", listed).option("lines", str(int(limit))).load()
