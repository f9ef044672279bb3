"""Operator 7, exact dedup: Grace hash deduplication with open-addressing tables.

Each map task first collapses the copies that it sees, so one content leaves it once for each
``BUCKET_BYTES`` of distinct text, however hot. The contents left are shuffled by hash. A hash whose
copies together would burden one task is hot: its copies are merged in salted groups first, so what
meets by hash is one content for each group. A task that cannot hold its share deals it to spill files
by further hash bits, again and again, until each bucket fits the table; the table compares whole
contents. Answers go back by the number of the collapsed class, which no more rows share than one map
task has read.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblytics.llm.common import texts, written

RECORD_BYTES = 200  # what an entry costs beside its content

BUCKET_BYTES = 16 << 20
FAN_BITS = 4
DEEPEST = 12  # levels of FAN_BITS bits below the 16 that the first table index uses
NO_ID = -(1 << 63)

COLLAPSED = "row bigint, doc_id bigint, class bigint, hash bigint, content binary, n bigint, best bigint, best_row bigint"
MERGED = "member bigint, class bigint, hash bigint, content binary, n bigint, best bigint, best_row bigint"
ANSWER = "class bigint, keep_id bigint, keep_row bigint, group_size bigint, text_sha256 string"


class ContentTable:
    """Open addressing with linear probing: content to entry number, compared byte by byte."""

    def __init__(self) -> None:
        self.slots = np.full(1 << 10, -1, dtype=np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def entry(self, hashed: int, content: bytes) -> int:
        """Number of the entry with this content, added if it is new."""
        slots, mask = self.slots, len(self.slots) - 1
        at = hashed & mask
        while (found := slots[at]) >= 0:
            if self.hashes[found] == hashed and self.contents[found] == content:
                return int(found)
            at = (at + 1) & mask
        slots[at] = number = len(self.contents)
        self.hashes.append(hashed)
        self.contents.append(content)
        self.bytes += len(content) + RECORD_BYTES
        if 2 * len(self.contents) > len(slots):
            self._grow()
        return number

    def _grow(self) -> None:
        slots = np.full(2 * len(self.slots), -1, dtype=np.int64)
        mask = len(slots) - 1
        for number, hashed in enumerate(self.hashes):
            at = hashed & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = number
        self.slots = slots


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the number of their class; each class once more with content, size and best row."""
    base = TaskContext.get().partitionId() << 33
    schema = pa.schema([(c, pa.binary() if c == "content" else pa.int64()) for c in
                        ("row", "doc_id", "class", "hash", "content", "n", "best", "best_row")])
    row, first = 0, 0
    table, sizes, best = ContentTable(), [], []

    def classes() -> Iterator[pa.RecordBatch]:
        step = 512
        for i in range(0, len(sizes), step):
            part = slice(i, i + step)
            k = len(sizes[part])
            yield pa.record_batch(
                [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                 pa.array([base + first + j for j in range(i, i + k)]),
                 pa.array([_signed(h) for h in table.hashes[part]]), pa.array(table.contents[part], pa.binary()),
                 pa.array(sizes[part]), pa.array([b[0] for b in best[part]]), pa.array([b[1] for b in best[part]])],
                schema=schema,
            )

    for batch in batches:
        ids = batch.column(0).to_pylist()
        contents = batch.column(1).cast(pa.binary())
        rows, numbers = [], []
        for doc_id, value in zip(ids, contents, strict=True):
            content = (value.as_py() or b"").lower()
            number = table.entry(xxhash.xxh3_64_intdigest(content), content)
            mine = (NO_ID if doc_id is None else doc_id, base + row)
            if number == len(sizes):
                sizes.append(1)
                best.append(mine)
            else:
                sizes[number] += 1
                best[number] = max(best[number], mine)
            rows.append(base + row)
            numbers.append(base + first + number)
            row += 1
            if table.bytes > BUCKET_BYTES:
                yield from classes()
                first += len(sizes)
                table, sizes, best = ContentTable(), [], []
        k = len(rows)
        empty = [pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), *[pa.nulls(k, pa.int64())] * 3]
        yield pa.record_batch([pa.array(rows, pa.int64()), batch.column(0), pa.array(numbers, pa.int64()), *empty], schema=schema)
    yield from classes()


Record = tuple[int, int, int, int, int, bytes]  # class, hash, n, best, best_row, content


def _resolve(records: Iterable[Record]) -> Iterator[tuple]:
    """One bucket in memory: an answer for each record's class."""
    table, members, sizes, best = ContentTable(), [], [], []
    for number, hashed, n, doc, row, content in records:
        at = table.entry(hashed, content)
        if at == len(members):
            members.append([number])
            sizes.append(n)
            best.append((doc, row))
        else:
            members[at].append(number)
            sizes[at] += n
            best[at] = max(best[at], (doc, row))
    for at, content in enumerate(table.contents):
        digest = hashlib.sha256(content).hexdigest()
        for number in members[at]:
            yield number, best[at][0], best[at][1], sizes[at], digest


def _spilled(spill) -> Iterator[Record]:
    spill.seek(0)
    while True:
        try:
            yield pickle.load(spill)
        except EOFError:
            return


def grace(records: Iterator[Record], bucket_bytes: int = BUCKET_BYTES, level: int = 0) -> Iterator[tuple]:
    """Resolve records in memory if they fit, else deal them to unnamed spill files and go down.

    At the deepest level all hash bits are used up, so what is left are copies of few contents, and the
    table holds each content once.
    """
    if level >= DEEPEST:
        yield from _resolve(records)
        return
    held, size = [], 0
    for record in records:
        held.append(record)
        size += len(record[-1]) + RECORD_BYTES
        if size > bucket_bytes:
            break
    else:
        yield from _resolve(held)
        return
    shift, mask = 64 - FAN_BITS * (level + 1), (1 << FAN_BITS) - 1
    spills = [tempfile.TemporaryFile() for _ in range(1 << FAN_BITS)]  # gone with the task, however it ends
    try:
        for part in (held, records):
            for record in part:
                pickle.dump(record, spills[(record[1] >> shift) & mask], pickle.HIGHEST_PROTOCOL)
            held = []
        for spill in spills:
            yield from grace(_spilled(spill), bucket_bytes, level + 1)
            spill.close()
    finally:
        for spill in spills:
            spill.close()


def merge_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of some salted groups: each with the class it joins, and each class joined once with its content.

    A class that others join keeps its own number. Beyond ``BUCKET_BYTES`` of distinct contents the table is
    emptied, so a content may come out again under another number; the groups meet by hash afterwards.
    """
    schema = pa.schema([(c, pa.binary() if c == "content" else pa.int64()) for c in
                        ("member", "class", "hash", "content", "n", "best", "best_row")])
    table, numbers, sizes, best = ContentTable(), [], [], []

    def joined() -> Iterator[pa.RecordBatch]:
        step = 512
        for i in range(0, len(sizes), step):
            part = slice(i, i + step)
            yield pa.record_batch(
                [pa.nulls(len(sizes[part]), pa.int64()), pa.array(numbers[part], pa.int64()),
                 pa.array([_signed(h) for h in table.hashes[part]]), pa.array(table.contents[part], pa.binary()),
                 pa.array(sizes[part]), pa.array([b[0] for b in best[part]]), pa.array([b[1] for b in best[part]])],
                schema=schema,
            )

    for batch in batches:
        members, into = [], []
        for number, hashed, n, doc, row, content in _records(batch):
            at = table.entry(hashed, content)
            if at == len(sizes):
                numbers.append(number)
                sizes.append(n)
                best.append((doc, row))
            else:
                sizes[at] += n
                best[at] = max(best[at], (doc, row))
            members.append(number)
            into.append(numbers[at])
            if table.bytes > BUCKET_BYTES:
                yield from joined()
                table, numbers, sizes, best = ContentTable(), [], [], []
        k = len(members)
        yield pa.record_batch([pa.array(members, pa.int64()), pa.array(into, pa.int64()), pa.nulls(k, pa.int64()),
                               pa.nulls(k, pa.binary()), *[pa.nulls(k, pa.int64())] * 3], schema=schema)
    yield from joined()


def _records(batch: pa.RecordBatch) -> Iterator[Record]:
    number, hashed, n, best, row, content = (batch.column(c) for c in ("class", "hash", "n", "best", "best_row", "content"))
    for i in range(batch.num_rows):
        yield (number[i].as_py(), hashed[i].as_py() % (1 << 64), n[i].as_py(), best[i].as_py(),
               row[i].as_py(), content[i].as_py())


def resolve_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("class", pa.int64()), ("keep_id", pa.int64()), ("keep_row", pa.int64()),
                        ("group_size", pa.int64()), ("text_sha256", pa.string())])
    out: list[tuple] = []
    for answer in grace(record for batch in batches for record in _records(batch)):
        out.append(answer)
        if len(out) == 8192:
            yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)
            out = []
    if out:
        yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)


def hot_hashes(classes: DataFrame, least_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Hashes of several classes that hold over a share of all bytes: hash, salts, the number of their groups.

    The share is a quarter of a shuffle partition's, or ``least_bytes`` if that is more. So they are fewer than four
    for each partition, and a group holds about one share.
    """
    partitions = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = written(
        classes.groupBy("hash").agg(
            F.sum(F.octet_length("content") + F.lit(RECORD_BYTES)).alias("bytes"), F.count(F.lit(1)).alias("classes")
        ).where("classes > 1"),
        "exact-shares",
    )
    total = held.agg(F.sum("bytes")).first()[0] or 0
    share = max(total // (4 * partitions), least_bytes)
    return held.where(F.col("bytes") > share).select("hash", F.ceil(F.col("bytes") / share).alias("salts"))


def resolved(classes: DataFrame, least_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The answer for each class, hot hashes by way of salted groups."""
    hot = written(hot_hashes(classes, least_bytes), "exact-hot")
    few = F.broadcast(hot)  # fewer than four for each shuffle partition
    cold = classes.join(few, "hash", "left_anti").repartition("hash").mapInArrow(resolve_partition, ANSWER)
    if hot.isEmpty():
        return cold
    groups = (
        classes.join(few, "hash")
        .withColumn("salt", F.pmod(F.xxhash64("class"), "salts"))
        .repartition("hash", "salt")
        .select(*classes.columns)
        .mapInArrow(merge_partition, MERGED)
    )
    groups = written(groups, "exact-groups")
    merged = groups.where(F.col("content").isNotNull()).select(*classes.columns).repartition("hash")
    members = groups.where(F.col("member").isNotNull()).select("member", "class")
    by_group = merged.mapInArrow(resolve_partition, ANSWER)
    return cold.unionByName(members.join(by_group, "class").drop("class").withColumnRenamed("member", "class"))


def exact_groups(docs: DataFrame, hot_bytes: int = BUCKET_BYTES, **names: str) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if their UTF-8 bytes are, after lower-casing A-Z; a null text is empty. The largest id
    of a group stays; null ids are smallest, and a group with null ids alone has a null keep_id. Among
    repeated rows with that id one stays, so each group keeps exactly one row. An empty table gives no rows.
    Copies of one hash with over ``hot_bytes`` are merged in groups first, see ``hot_hashes``.
    """
    rows = written(texts(docs, **names).mapInArrow(collapse, COLLAPSED), "exact")
    classes = rows.where(F.col("content").isNotNull()).select("class", "hash", "n", "best", "best_row", "content")
    members = rows.where(F.col("row").isNotNull()).select("row", "doc_id", "class")
    return members.join(resolved(classes, hot_bytes), "class").select(
        "doc_id",
        F.when(F.col("keep_id") != NO_ID, F.col("keep_id")).alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        "text_sha256",
    )
