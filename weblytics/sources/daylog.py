"""A data source of its own for log folders: format ``daylog``, one fixed ``line`` for each line of text.

``spark.read.format("daylog").load(root)`` reads every ``<root>/day=<day>/``. Files are cut into byte ranges, one
partition each; a range owns the lines that begin in it, so a line across a border is read once. A filter of
``day`` to constants is taken over by the source: other folders are not listed.

Files are opened through Arrow's file systems, in tasks, so ``root`` may be a path or a URI that Arrow knows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from weblytics.session import ship_package

FORMAT = "daylog"
SCHEMA = "line string, day string"
PARTITION_BYTES = 128 << 20
READ_BYTES = 4 << 20
BREAK = b"\n"


@dataclass
class ByteRange(InputPartition):
    path: str
    day: str
    first: int
    last: int  # lines that begin before this place, and not before ``first``


def opened(root: str) -> tuple[fs.FileSystem, str]:
    if "://" in root or root.startswith("file:"):
        if root.startswith("file:") and not root.startswith("file://"):
            root = "file://" + root.removeprefix("file:")
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root


def lines_between(stream, size: int, first: int, last: int, read_bytes: int = READ_BYTES) -> Iterator[list[bytes]]:
    """Lists of the lines that begin in ``[first, last)`` of a file of ``size`` bytes."""
    at = max(first - 1, 0)  # a line begins at ``first`` only if a break lies before it
    stream.seek(at)
    rest, skipping = b"", first > 0
    begin = at  # place where ``rest`` begins
    while begin < last or skipping:
        data = stream.read(read_bytes)
        if not data:
            if not skipping and rest and begin < last:
                yield [rest]
            return
        rest += data
        if skipping:
            found = rest.find(BREAK)
            if found < 0:
                begin, rest = begin + len(rest), b""
                continue
            begin, rest, skipping = begin + found + 1, rest[found + 1 :], False
        lines = rest.split(BREAK)
        rest = lines.pop()
        out = []
        for line in lines:
            if begin >= last:
                break
            out.append(line)
            begin += len(line) + 1
        if out:
            yield out
        if begin >= last:
            return


class DayLogReader(DataSourceReader):
    def __init__(self, root: str, partition_bytes: int) -> None:
        self.root, self.partition_bytes = root.rstrip("/"), partition_bytes
        self.days: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keep what fixes the day; give back the others."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("day",):
                self._only({f.value})
            elif isinstance(f, In) and f.attribute == ("day",):
                self._only(set(f.value))
            else:
                yield f

    def _only(self, days: set[str]) -> None:
        self.days = days if self.days is None else self.days & days

    def _folders(self, files: fs.FileSystem, path: str) -> Iterator[tuple[str, str]]:
        if self.days is not None:
            yield from ((f"{path}/day={day}", day) for day in sorted(d for d in self.days if d is not None))
            return
        for found in files.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            if found.type == fs.FileType.Directory and found.base_name.startswith("day="):
                yield found.path, found.base_name.removeprefix("day=")

    def partitions(self) -> list[ByteRange]:
        files, path = opened(self.root)
        out = []
        for folder, day in self._folders(files, path):
            for found in files.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if found.type == fs.FileType.File and not found.base_name.startswith(("_", ".")):
                    starts = range(0, found.size, self.partition_bytes)
                    out += [ByteRange(found.path, day, a, min(a + self.partition_bytes, found.size)) for a in starts]
        return out or [ByteRange("", "", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        files, _ = opened(self.root)
        with files.open_input_file(partition.path) as stream:
            for lines in lines_between(stream, stream.size(), partition.first, partition.last):
                texts = [x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines]
                yield pa.record_batch([pa.array(texts, pa.string()), pa.array([partition.day] * len(texts), pa.string())], names=["line", "day"])


class DayLogSource(DataSource):
    """Options: ``path``, the folder of the days; ``partitionbytes``, the size of a byte range."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DayLogReader:
        return DayLogReader(self.options["path"], int(self.options.get("partitionbytes", PARTITION_BYTES)))


def register_daylog(spark: SparkSession) -> None:
    """Make the format known to a session. Filters reach a Python source only with this setting."""
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DayLogSource)
