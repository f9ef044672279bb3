"""A stream source with offsets of its own: format ``eventlog``, an append-only log of numbered segments.

A topic is a folder with ``partition=<number>/<first offset>.jsonl`` segments, each finished before it is seen. An
offset is, for each partition, the number of the next event. Spark keeps it in the stream's checkpoint, so a run that was
killed reads the events of its unfinished batch again, the same ones, and then goes on; none is left out or taken
twice by a sink that replaces a replayed batch. ``maxeventspertrigger`` admits so many events a batch, shared by the
partitions; the rest waits for the next one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from weblytics.session import ship_package
from weblytics.sources.daylog import opened

FORMAT = "eventlog"
SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
MAX_EVENTS = 1_000_000
_KINDS = pa.schema([
    ("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()), ("event_type", pa.string()), ("value", pa.float64()),
])
_BATCH = 8192


@dataclass
class Segment(InputPartition):
    path: str
    skip: int  # events of the segment before the range
    take: int


class EventLogReader(DataSourceStreamReader):
    def __init__(self, root: str, most: int) -> None:
        self.root, self.most = root.rstrip("/"), most
        self.at: dict[str, int] | None = None  # where the last admitted batch ended

    def _segments(self) -> dict[str, list[tuple[int, int, str]]]:
        """By partition the segments in order: first offset, offset after the last event, path.

        The name holds both, ``<first>-<after>.jsonl``, so nothing is opened to learn how far the log reaches.
        """
        files, path = opened(self.root)
        out: dict[str, list[tuple[int, int, str]]] = {}
        for found in files.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True)):
            name = found.base_name
            if found.type == fs.FileType.File and name.endswith(".jsonl") and not name.startswith(("_", ".")):
                partition = found.path.rsplit("/", 2)[-2].removeprefix("partition=")
                first, after = name.removesuffix(".jsonl").split("-")
                out.setdefault(partition, []).append((int(first), int(after), found.path))
        return {k: sorted(v) for k, v in sorted(out.items())}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """How far the next batch may read: behind the last one by the share of each partition at most."""
        ends = {p: s[-1][1] for p, s in self._segments().items()}
        before = self.at or {}
        share = max(1, self.most // max(1, len(ends)))
        self.at = {p: min(end, before.get(p, 0) + share) for p, end in ends.items()}
        return self.at

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        self.at = {p: max(n, (self.at or {}).get(p, 0)) for p, n in end.items()}  # after a restart: what was promised before
        out = []
        for partition, segments in self._segments().items():
            first, after = start.get(partition, 0), end.get(partition, 0)
            for a, z, path in segments:
                if max(a, first) < min(z, after):
                    out.append(Segment(path, max(0, first - a), min(z, after) - max(a, first)))
        return out

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        files, _ = opened(self.root)
        rows: list[dict] = []
        with files.open_input_stream(partition.path) as stream:
            for number, line in enumerate(_lines(stream)):
                if number < partition.skip:
                    continue
                if number >= partition.skip + partition.take:
                    break
                event = json.loads(line)
                event["ts"] = None if event.get("ts") is None else datetime.fromisoformat(event["ts"])
                rows.append(event)
                if len(rows) == _BATCH:
                    yield pa.RecordBatch.from_pylist(rows, schema=_KINDS)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_KINDS)

    def commit(self, end: dict) -> None:
        """Segments stay; their owner removes them."""


def _lines(stream) -> Iterator[bytes]:
    rest = b""
    while data := stream.read(1 << 20):
        *lines, rest = (rest + data).split(b"\n")
        yield from lines
    if rest:
        yield rest


class EventLogSource(DataSource):
    """Options: ``path``, the topic; ``maxeventspertrigger``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> EventLogReader:
        return EventLogReader(self.options["path"], int(self.options.get("maxeventspertrigger", MAX_EVENTS)))


def stream_event_log(spark: SparkSession, root: str, most: int = MAX_EVENTS) -> DataFrame:
    """The events of a topic as a stream."""
    ship_package(spark)
    spark.dataSource.register(EventLogSource)
    return spark.readStream.format(FORMAT).option("maxeventspertrigger", most).load(root)
