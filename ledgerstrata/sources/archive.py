"""Bulk archives: zip files that hold one JSON document per company.

Spark does not unzip. An archive is one file but its members are independently
compressed, so an archive splits as a text file does: every ``chunk_bytes`` of it are
one input partition, and a member belongs to the partition in which it starts. Each
task reads the member table of its archive and seeks to its own members. This is a
Spark data source: planning lists files, starts no job and opens no archive, and
nothing is shuffled. No content passes through the driver.

An empty archive has no members. An archive or member that cannot be read gives
a row without a document and with the reason in ``error``; it never stops the
others. Failures of the storage itself still fail the task, which is retried.
"""

from __future__ import annotations

import io
import json
import os
import re
import sys
import weakref
import zipfile
import zlib
from contextlib import contextmanager
from fnmatch import fnmatchcase
from math import ceil

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Workers get the helpers of this module with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_SCHEMA = (
    "archive string, first_member int, members int, chunk_bytes long, error string"
)
MEMBER_SCHEMA = "archive string, member string, doc_json string, error string"
DAMAGE = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, UnicodeDecodeError)
FORMAT = "zip_members"
CHUNK_BYTES = 4 << 20  # zipped; JSON of this kind is about eight times as large
BATCH_BYTES = 16 << 20
_REGISTERED: weakref.WeakSet = weakref.WeakSet()


class _Seekable(io.RawIOBase):
    """A file of the storage layer that refuses wrong offsets as a plain file does."""

    def __init__(self, file):
        self._file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._file.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        start = {io.SEEK_SET: 0, io.SEEK_CUR: self._file.tell(), io.SEEK_END: self._file.size()}[whence]
        if start + offset < 0:
            raise OSError(22, "negative seek position")
        self._file.seek(start + offset)
        return start + offset

    def readinto(self, buffer) -> int:
        data = self._file.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


def _filesystem(path: str):
    """The file system of a path or address, and the path in it."""
    from pyarrow import fs

    # Spark's names for the same stores.
    path = re.sub(r"^s3[an]://", "s3://", path)
    path = path if "://" in path or path.startswith("file:") else os.path.abspath(path)
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


@contextmanager
def _opened(archive: str):
    filesystem, name = _filesystem(archive)
    with filesystem.open_input_file(name) as raw:
        with zipfile.ZipFile(io.BufferedReader(_Seekable(raw), 1 << 20)) as opened:
            yield opened


def _reason(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def _archives(spark: SparkSession, path: str | list[str]) -> DataFrame:
    # Only path and length are selected, so the file content is never loaded here.
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return files.select(F.col("path").alias("archive"), "length")


def list_members(
    spark: SparkSession,
    path: str | list[str],
    *,
    suffix: str = ".json",
    chunk_bytes: int = 32 << 20,
) -> DataFrame:
    """Chunks of consecutive members, each up to ``chunk_bytes`` of plain text.

    A member larger than the limit gets a chunk of its own. A damaged archive is
    one row without members and with an ``error``.
    """

    def chunks(batches):
        import pandas as pd

        for batch in batches:
            for archive in batch["archive"]:
                rows, first, count, size = [], 0, 0, 0
                try:
                    with _opened(archive) as opened:
                        for index, info in enumerate(opened.infolist()):
                            wanted = info.file_size if info.filename.endswith(suffix) else 0
                            if count and size + wanted > chunk_bytes:
                                rows.append((archive, first, count, size, None))
                                first, count, size = index, 0, 0
                            count += 1
                            size += wanted
                        if count:
                            rows.append((archive, first, count, size, None))
                except DAMAGE as error:
                    rows = [(archive, 0, 0, 0, _reason(error))]
                yield pd.DataFrame(
                    rows, columns=["archive", "first_member", "members", "chunk_bytes", "error"]
                )

    return _archives(spark, path).select("archive").mapInPandas(chunks, CHUNK_SCHEMA)


def _files(path: str, suffix: str) -> list[tuple[str, int]]:
    """``(address, bytes)`` of the files under a path; its parts may hold ``*``, ``?`` and ``[..]``."""
    from pyarrow import fs

    parts = path.rstrip("/").split("/")
    plain = next((i for i, part in enumerate(parts) if re.search(r"[*?\[]", part)), len(parts))
    filesystem, root = _filesystem("/".join(parts[:plain]) or "/")
    pattern = parts[plain:]
    info = filesystem.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        found = [info]
    else:
        found = filesystem.get_file_info(fs.FileSelector(root, recursive=True))
    scheme = "/".join(parts[:plain])
    out = []
    for file in found:
        below = file.path[len(root) :].strip("/").split("/") if file.path != root else []
        if file.type != fs.FileType.File or not file.path.endswith(suffix):
            continue
        if len(below) < len(pattern) or not all(map(fnmatchcase, below, pattern)):
            continue
        # Hidden files, as Spark passes over them.
        if not any(part.startswith((".", "_")) for part in below):
            out.append(("/".join([scheme, *below]), file.size))
    return sorted(out)


class _Chunk(InputPartition):
    """The members of an archive that start in ``[low, high)``."""

    def __init__(self, archive: str, low: int, high: int):
        super().__init__((archive, low, high))
        self.archive, self.low, self.high = archive, low, high


class _Members(DataSourceReader):
    def __init__(self, options):
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.suffix = options.get("suffix", ".json")
        self.chunk_bytes = int(options.get("chunkBytes", CHUNK_BYTES))
        self.tasks = int(options.get("tasks", 0))
        self.batch_bytes = int(options.get("batchBytes", BATCH_BYTES))

    def partitions(self) -> list[_Chunk]:
        files = [file for path in self.paths for file in _files(path, ".zip")]
        size = self.chunk_bytes
        if self.tasks:
            size = max(1, ceil(sum(length for _, length in files) / self.tasks))
        return [
            _Chunk(archive, low, low + size) for archive, length in files for low in range(0, length, size)
        ]

    def _rows(self, part: _Chunk):
        try:
            with _opened(part.archive) as opened:
                for info in opened.infolist():
                    if not info.filename.endswith(self.suffix) or not part.low <= info.header_offset < part.high:
                        continue
                    try:
                        yield part.archive, info.filename, opened.read(info).decode("utf-8"), None
                    except DAMAGE as error:
                        yield part.archive, info.filename, None, _reason(error)
        except DAMAGE as error:
            # An archive that cannot be opened is reported by its first partition.
            if part.low == 0:
                yield part.archive, None, None, _reason(error)

    def read(self, part: _Chunk):
        import pyarrow as pa

        def batch(rows):
            columns = [pa.array(column, pa.string()) for column in zip(*rows)]
            return pa.RecordBatch.from_arrays(columns, names=["archive", "member", "doc_json", "error"])

        rows, size = [], 0
        for row in self._rows(part):
            rows.append(row)
            size += len(row[2] or "")
            if size >= self.batch_bytes:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)


class ZipMembers(DataSource):
    """``spark.read.format("zip_members").load(path)``: one row per archive member.

    Options: ``path`` or ``paths`` (a JSON list); ``suffix`` of the members;
    ``chunkBytes`` of an archive per input partition, or the number of ``tasks``;
    ``batchBytes`` of text handed over at once.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MEMBER_SCHEMA

    def reader(self, schema) -> _Members:
        return _Members(self.options)


def read_archive(
    spark: SparkSession,
    path: str | list[str],
    *,
    suffix: str = ".json",
    chunk_bytes: int = CHUNK_BYTES,
    tasks: int | None = None,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``(archive, member, doc_json, error)`` for every member ending in ``suffix``.

    One task per ``chunk_bytes`` of an archive as stored; with ``tasks`` the archives
    are cut into about that many parts instead. Files are listed when the frame is
    executed.
    """
    if spark not in _REGISTERED:
        spark.dataSource.register(ZipMembers)
        _REGISTERED.add(spark)
    reader = spark.read.format(FORMAT).option("paths", json.dumps([path] if isinstance(path, str) else path))
    reader = reader.option("suffix", suffix).option("chunkBytes", chunk_bytes).option("batchBytes", batch_bytes)
    return (reader.option("tasks", tasks) if tasks else reader).load()
