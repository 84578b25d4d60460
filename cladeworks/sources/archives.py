"""Release archives as tables of lines: zip, tar, tar.gz, gz and plain text.

``read`` is a Python data source whose partitions are the members of zip files
and whole tar and gz files (these can only be read from their start); they are
streamed on the executors, a batch of lines at a time.  It needs paths that the
driver and all executors can open.  For other stores ``unpacked`` takes the
archives' bytes, such as Spark's ``binaryFile`` gives them.
"""

from __future__ import annotations

import glob
import gzip
import io
import os
import tarfile
import zipfile
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "archive string, member string, line_no long, value string"
_ARROW = pa.schema([("archive", pa.string()), ("member", pa.string()), ("line_no", pa.int64()), ("value", pa.string())])
#: Characters of lines in one batch.
_BATCH = 4 << 20


def kind_of(name: str) -> str:
    low = name.lower()
    if low.endswith((".tar.gz", ".tgz", ".tar")):
        return "tar"
    return "zip" if low.endswith(".zip") else "gz" if low.endswith((".gz", ".gzip")) else "text"


def _bare(name: str) -> str:
    base = name.rsplit("/", 1)[-1]
    return base.removesuffix(".gz").removesuffix(".gzip")


def _members(name: str, raw: BinaryIO, only: str | None = None) -> Iterator[tuple[str, BinaryIO]]:
    """(member, stream) in turn; each stream is read before the next is asked for."""
    kind = kind_of(name)
    if kind == "zip":
        with zipfile.ZipFile(raw) as z:
            for info in z.infolist():
                if not info.is_dir() and only in (None, info.filename):
                    with z.open(info) as stream:
                        yield info.filename, stream
    elif kind == "tar":
        plain = raw if name.lower().endswith(".tar") else gzip.open(raw)
        with tarfile.open(fileobj=plain, mode="r:") as t:  # its members are read in turn, so the stream only goes forward
            for info in t:
                if info.isfile() and (stream := t.extractfile(info)) is not None:
                    yield info.name.removeprefix("./"), stream
    elif kind == "gz":
        with gzip.open(raw) as stream:
            yield _bare(name), stream
    else:
        yield _bare(name), raw


def _batches(name: str, raw: BinaryIO, only: str | None = None) -> Iterator[pa.RecordBatch]:
    for member, stream in _members(name, raw, only):
        held, size, first = [], 0, 0
        for line in io.TextIOWrapper(stream, encoding="utf-8", errors="replace", newline=None):
            held.append(line.removesuffix("\n"))
            size += len(line)
            if size >= _BATCH:
                yield _batch(name, member, first, held)
                held, size, first = [], 0, first + len(held)
        if held:
            yield _batch(name, member, first, held)


def _batch(name: str, member: str, first: int, lines: list[str]) -> pa.RecordBatch:
    n = len(lines)
    return pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array([member] * n, pa.string()), pa.array(range(first, first + n), pa.int64()), pa.array(lines, pa.string())], schema=_ARROW)


class _Part(InputPartition):
    def __init__(self, path: str, member: str | None):
        self.path, self.member = path, member


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path.removeprefix("file://")

    def partitions(self) -> list[InputPartition]:
        files = sorted(glob.glob(os.path.join(self.path, "*")) if os.path.isdir(self.path) else glob.glob(self.path))
        if not files:
            raise FileNotFoundError(self.path)
        parts: list[InputPartition] = []
        for path in filter(os.path.isfile, files):
            if kind_of(path) == "zip":
                with zipfile.ZipFile(path) as z:  # its directory only
                    parts += [_Part(path, info.filename) for info in z.infolist() if not info.is_dir()]
            else:
                parts.append(_Part(path, None))
        return parts

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        with open(partition.path, "rb") as raw:
            yield from _batches(partition.path, raw, partition.member)


class ArchiveSource(DataSource):
    """spark.read.format("archive").load(path): a file, a folder or a pattern."""

    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """archive, member, line_no (from 0), value of all lines of the archives at ``path``; bytes that are no UTF-8 are replaced.

    Empty members have no rows; a path without files raises.
    """
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("archive").load(path)


def unpacked(contents: DataFrame) -> DataFrame:
    """The same of archives given as (path, content); null contents have no rows."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                name, raw = batch.column(0)[k].as_py(), batch.column(1)[k]
                yield from _batches(name, pa.BufferReader(raw.as_buffer()))

    return contents.filter("content is not null").select("path", "content").mapInArrow(lines, SCHEMA)


def unpack(lines: DataFrame, folder: str, members: list[str]) -> None:
    """Writes the lines of the named members (by their last part) as text into folders of that name, where the readers of a format find them."""
    for name in members:
        lines.filter(F.element_at(F.split("member", "/"), -1) == name).select("value").write.text(f"{folder.rstrip('/')}/{name}")
