"""Operator 2, suffix-array dedup: a distributed merge sort that is aware of common prefixes.

A byte goes if a ``span``-byte string that covers it also starts in a document with a smaller id.

Suffixes start at anchors: of the ``k``-byte strings inside each window of ``span`` bytes the one with
the least hash. The choice depends on the window alone, so equal windows have equal anchors, and one
suffix with some bytes before it stands for up to ``span - k + 1`` windows. As in published string sorters,
hashes of prefixes are exchanged first, to find those that occur once; their suffixes stay at home.

1. Documents are put into blocks of some MB and written, compressed, once.
2. Each block sends its distinct prefix hashes; those seen twice or more come back to it.
3. Each block sorts the suffixes at the anchors left, joins equal ones, front-codes the run of each prefix class
   and sends it. A class with very many suffixes is sent as single windows, dealt by all their bytes, so
   that no class gathers in one task.
4. A task merges the runs of its classes by a loser tree; ranks of the right and left contexts, from the shared
   prefix lengths, group equal windows exactly, and each group's least document stays. A run has one row for equal
   suffixes of a block, with their least document; their places, and windows settled inside the block, wait at home,
   in a group of the block's own, so a window that all documents share sends one row for each block.
5. The removed windows of each row come back to the blocks, which know its places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

from weblytics.llm.common import texts, written
from weblytics.llm.loser_tree import common_prefixes, front_code, front_decode, merge_runs

SPAN = 50
BLOCK_BYTES = 8 << 20
SLICE_BITS = 19  # bytes hashed at once; places inside a slice fill the low bits of a hash
BUCKETS_PER_PARTITION = 4  # a task holds one bucket at a time
HASH_BYTES = 6
HOME = -1  # bucket number of what waits for its block
MANY = 4096  # suffixes of one class above which it is sent as single windows
NO_ID = (1 << 63) - 1
GOLD = np.uint64(0x9E3779B97F4A7C15)
ODD = np.uint64(0x94D049BB133111EB)
BLOCK_SCHEMA = "block bigint, ids binary, nulls binary, sizes binary, packed binary, beside binary"
SENT = "block bigint, bucket int, payload binary"


def prefix_bytes(span: int) -> int:
    for k in (24, 16, 8):
        if span >= 2 * k:
            return k
    raise ValueError("span must be 16 or more")


def _pack(*arrays: np.ndarray) -> bytes:
    heads = np.array([a.nbytes for a in arrays], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=9).compress(heads + b"".join(a.tobytes() for a in arrays))


def _unpack(payload: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    heads, at, out = np.frombuffer(raw, "<i8", len(kinds)), 8 * len(kinds), []
    for size, kind in zip(heads.tolist(), kinds, strict=True):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def prefix_hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` bytes at each place, ``k`` a multiple of 8, by doubling."""
    h = raw.astype(np.uint64) + np.uint64(1)
    for step in (1, 2, 4):
        h = h[:-step] * ODD + h[step:] * GOLD
        if step != 2:
            _mix(h)
    n = len(raw) - k + 1
    total = h[:n].copy()
    for at in range(8, k, 8):
        total = _mix(total * ODD + h[at : at + n])
    return total


def anchors(raw: np.ndarray, ends: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """Anchor, first window and last window of each stretch of windows with one anchor; and the hash there.

    ``ends`` are the document ends in ``raw``; windows across an end do not count.
    """
    k = prefix_bytes(span)
    width = span - k + 1
    step = (1 << SLICE_BITS) - span
    low = np.uint64((1 << SLICE_BITS) - 1)
    found: list[list[np.ndarray]] = [[], [], [], []]
    starts = np.concatenate(([0], ends[:-1]))
    for at in range(0, len(raw) - span + 1, step):
        piece = raw[at : at + step + span - 1]
        h = prefix_hashes(piece, k)
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # equal hashes: the first place
        reach = 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: -(width - reach)], least[width - reach :])
        n = len(least)
        inside = np.zeros(n + 1, np.int32)
        a, b = np.clip(starts - at, 0, n), np.clip(ends - span + 1 - at, 0, n)
        full = b > a
        np.add.at(inside, a[full], 1)
        np.add.at(inside, b[full], -1)
        windows = np.flatnonzero(np.cumsum(inside[:-1]))
        if not len(windows):
            continue
        place = (least[windows] & low).astype(np.int64)
        cut = np.flatnonzero((place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)) + 1
        first = np.concatenate(([0], cut))
        last = np.append(cut, len(windows)) - 1
        found[0].append(place[first] + at)
        found[1].append(windows[first] + at)
        found[2].append(windows[last] + at)
        found[3].append(h[place[first]] >> np.uint64(64 - 8 * HASH_BYTES))
    kinds = (np.int64, np.int64, np.int64, np.uint64)
    return tuple(np.concatenate(x) if x else np.empty(0, t) for x, t in zip(found, kinds, strict=True))


def _hash_bytes(hashes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES])


def _hashes(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw) // HASH_BYTES, 8), np.uint8)
    wide[:, :HASH_BYTES] = raw.reshape(-1, HASH_BYTES)
    return wide.view("<u8").ravel()


def _buckets(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket numbers from mixed bits: an anchor has the least hash around it, so small hashes are common."""
    return ((hashes * GOLD >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _in_utc(kind: pa.DataType) -> pa.DataType:
    """The type with its times in UTC: Spark sends instants in the session's zone and takes them back in UTC."""
    if pa.types.is_timestamp(kind) and kind.tz:
        return pa.timestamp(kind.unit, "UTC")
    if pa.types.is_struct(kind):
        return pa.struct([f.with_type(_in_utc(f.type)) for f in kind])
    if pa.types.is_list(kind):
        return pa.list_(kind.value_field.with_type(_in_utc(kind.value_type)))
    if pa.types.is_map(kind):
        return pa.map_(kind.key_field.with_type(_in_utc(kind.key_type)), kind.item_field.with_type(_in_utc(kind.item_type)))
    return kind


def _beside(columns: list[pa.Array]) -> bytes:
    """The carried column of a block, compressed; no bytes if nothing is carried."""
    if not columns:
        return b""
    sink = pa.BufferOutputStream()
    table = pa.table({"carried": pa.chunked_array(columns).cast(_in_utc(columns[0].type))})
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    return zstandard.ZstdCompressor(level=9).compress(sink.getvalue().to_pybytes())


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in their order, a block each time ``BLOCK_BYTES`` are reached."""
    number = TaskContext.get().partitionId() << 33
    ids: list[int] = []
    nulls: list[bool] = []
    parts: list[bytes] = []
    beside: list[pa.Array] = []
    held = 0

    def block() -> pa.RecordBatch:
        packed = zstandard.ZstdCompressor(level=9).compress(b"".join(parts))
        sizes = np.array([len(p) for p in parts], "<i8")
        values = [[number], [np.array(ids, "<i8").tobytes()], [np.array(nulls, bool).tobytes()], [sizes.tobytes()], [packed],
                  [_beside(beside)]]
        return pa.record_batch(
            [pa.array(v, pa.binary() if k else pa.int64()) for k, v in enumerate(values)],
            names=["block", "ids", "nulls", "sizes", "packed", "beside"],
        )

    for batch in batches:
        carried = batch.columns[2:]
        width = 64 + sum(c.nbytes for c in carried) // max(batch.num_rows, 1)
        first = 0
        for i, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()))):
            ids.append(NO_ID if doc_id is None else doc_id)
            nulls.append(doc_id is None)
            parts.append(text.as_py() or b"")
            held += len(parts[-1]) + width
            if held >= BLOCK_BYTES:
                beside += [c.slice(first, i + 1 - first) for c in carried]
                first = i + 1
                yield block()
                number += 1
                ids, nulls, parts, beside, held = [], [], [], [], 0
        if first < batch.num_rows:
            beside += [c.slice(first) for c in carried]
    if ids:
        yield block()


def _block(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, document ends and document ids of a block."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["packed"]), np.uint8)
    return raw, np.cumsum(np.frombuffer(row["sizes"], "<i8")), np.frombuffer(row["ids"], "<i8")


def _grouped(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns)


class SuffixDedup:
    """The functions that run in tasks, with their parameters."""

    def __init__(self, span: int, buckets: int, as_text: bool = False) -> None:
        self.span, self.buckets, self.as_text = span, buckets, as_text
        self.k = prefix_bytes(span)
        self.reach = span - self.k  # windows begin up to so many bytes before their anchor

    def send_hashes(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each block and bucket: hashes that occur once in the block, those that occur again, and their counts."""
        for batch in batches:
            for row in batch.to_pylist():
                raw, ends, _ = _block(row)
                hashes, counts = np.unique(anchors(raw, ends, self.span)[3], return_counts=True)
                buckets = _buckets(hashes, self.buckets)
                by_bucket = np.argsort(buckets, kind="stable")
                hashes, counts = hashes[by_bucket], counts[by_bucket]
                edges = np.searchsorted(buckets[by_bucket], np.arange(self.buckets + 1))
                out = []
                for b in range(self.buckets):
                    h, c = hashes[edges[b] : edges[b + 1]], counts[edges[b] : edges[b + 1]]
                    if len(h):
                        again = c > 1
                        out.append((row["block"], b, _pack(_hash_bytes(h[~again]), _hash_bytes(h[again]), c[again].astype("<u4"))))
                yield self._sent(out)

    @staticmethod
    def _sent(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.binary())
        return pa.record_batch(
            [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["block", "bucket", "payload"]
        )

    def answer_hashes(self, rows: pd.DataFrame) -> pd.DataFrame:
        """For each block its hashes that occur twice or more over all blocks, and whether they are many."""
        parts, sizes = [], []
        for payload in rows["payload"]:
            once, again, counts = _unpack(payload, "u1", "u1", "<u4")
            once, again = _hashes(once), _hashes(again)
            parts.append((np.concatenate([once, again]), np.concatenate([np.ones(len(once), np.int64), counts])))
            sizes.append(len(once) + len(again))
        hashes = np.concatenate([p[0] for p in parts])
        _, owner = np.unique(hashes, return_inverse=True)
        totals = np.bincount(owner, np.concatenate([p[1] for p in parts]))[owner]
        out, at = [], 0
        for block, size in zip(rows["block"], sizes):
            total = totals[at : at + size]
            shared = total > 1
            if shared.any():
                out.append((block, 0, _pack(_hash_bytes(hashes[at : at + size][shared]), total[shared] > MANY)))
            at += size
        return _grouped(out, ["block", "bucket", "payload"])

    def send_runs(self, blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        """Front-coded runs of a block for each bucket, and what stays at home: places of their rows, settled windows."""
        columns = ["block", "bucket", "payload"]
        if not len(blocks) or not len(answers):
            return _grouped([], columns)
        row = blocks.iloc[0]
        raw, ends, ids = _block(row)
        place, first, last, hashes = anchors(raw, ends, self.span)
        got = [_unpack(p, "u1", "?") for p in answers["payload"]]
        known, many = np.concatenate([_hashes(g[0]) for g in got]), np.concatenate([g[1] for g in got])
        order = np.argsort(known)
        known, many = known[order], many[order]
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        shared = known[at] == hashes
        place, first, last, hashes, hot = place[shared], first[shared], last[shared], hashes[shared], many[at[shared]]
        if hot.any():
            spread = np.repeat(np.flatnonzero(hot), (last - first + 1)[hot])
            begin = np.concatenate(([0], np.cumsum((last - first + 1)[hot])))[:-1]
            windows = first[spread] + np.arange(len(spread)) - np.repeat(begin, (last - first + 1)[hot])
            place = np.concatenate([place[~hot], windows])
            first, last = np.concatenate([first[~hot], windows]), np.concatenate([last[~hot], windows])
            hashes = np.concatenate([hashes[~hot], self._window_hashes(raw, windows)])
        buckets = _buckets(hashes, self.buckets)
        docs = ids[np.searchsorted(ends, place, side="right")]
        padded = np.concatenate([np.zeros(self.reach, np.uint8), raw, np.zeros(self.span, np.uint8)])
        view = np.lib.stride_tricks.sliding_window_view(padded, self.reach + self.span)
        out, sent, members, places, settled = [], [], [], [], []
        by_bucket = np.argsort(buckets, kind="stable")
        edges = np.searchsorted(buckets[by_bucket], np.arange(self.buckets + 1))
        for b in range(self.buckets):
            mine = by_bucket[edges[b] : edges[b + 1]]
            if len(mine):
                run, count, where, gone = self._run(view, place[mine], first[mine], last[mine], docs[mine])
                out.append((row["block"], b, run))
                sent.append((b, len(count)))
                members.append(count)
                places.append(where)
                settled.append(gone)
        if sent:
            home = np.array(sent, "<u4"), np.concatenate(members), np.concatenate(places), np.concatenate(settled, axis=1)
            out.append((row["block"], HOME, _pack(*home)))
        return _grouped(out, columns)

    def _window_hashes(self, raw: np.ndarray, windows: np.ndarray) -> np.ndarray:
        view = np.lib.stride_tricks.sliding_window_view(raw, self.span)
        out = np.empty(len(windows), np.uint64)
        for i in range(0, len(windows), 1 << 15):
            rows = view[windows[i : i + (1 << 15)]]
            total = np.zeros(len(rows), np.uint64)
            for c in range(self.span):
                total = total * ODD + rows[:, c] + np.uint64(1)
                if c % 4 == 3:
                    _mix(total)
            out[i : i + (1 << 15)] = _mix(_mix(total))
        return out >> np.uint64(64 - 8 * HASH_BYTES)

    def _run(
        self, view: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray, docs: np.ndarray
    ) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """Sort the suffixes of one bucket, join equal ones, settle all but the least document, front-code.

        Beside the run: for each of its rows the number of places, the places, and the windows settled here.
        """
        near, far = place - last, place - first  # windows begin near to far bytes before the anchor
        both = view[place]  # a copy: left context, then the suffix
        column = np.arange(self.reach + self.span)
        both[(column < self.reach - far[:, None]) | (column >= self.reach + self.span - near[:, None])] = 0
        keys = np.empty((len(place), self.reach + self.span + 2), np.uint8)
        keys[:, : self.span] = both[:, self.reach :]
        keys[:, self.span : -2] = both[:, self.reach - 1 :: -1] if self.reach else both[:, :0]
        keys[:, -2], keys[:, -1] = near, far
        order = np.argsort(keys.view(f"S{keys.shape[1]}").ravel(), kind="stable")
        keys, docs, place, near, far = keys[order], docs[order], place[order], near[order], far[order]
        new = common_prefixes(keys) < keys.shape[1]
        new[0] = True
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        least = np.minimum.reduceat(docs, starts)
        settled = docs > least[group]
        gone = np.stack([(place - far)[settled], (place - near + self.span)[settled]])
        stay = ~settled
        members = np.bincount(group[stay], minlength=len(starts))
        rows = keys[starts]
        shared, tails = front_code(np.ascontiguousarray(rows[:, : self.span]))
        left = rows[:, self.span : -2]
        used = np.arange(left.shape[1]) < rows[:, -1][:, None]
        run = _pack(shared, tails, rows[:, -2].copy(), rows[:, -1].copy(), left[used], least.astype("<i8"))
        return run, members.astype("<u4"), place[stay].astype("<u4"), gone.astype("<u4")

    def merge(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Merge the runs of one bucket and say, for each block, which windows of which rows of its run go."""
        if rows["bucket"].iloc[0] == HOME:
            return rows[["block", "bucket", "payload"]]
        runs, lefts, least, near, far = [], [], [], [], []
        for payload in rows["payload"]:
            shared, tails, n, f, left, doc = _unpack(payload, "u1", "u1", "u1", "u1", "u1", "<i8")
            runs.append((front_decode(shared, tails, self.span), shared))
            filled = np.zeros((len(shared), self.reach), np.uint8)
            filled[np.arange(self.reach) < f[:, None]] = left
            lefts.append(filled)
            least.append(doc)
            near.append(n)
            far.append(f)
        sizes = np.array([len(r[0]) for r in runs])
        order, shared = merge_runs(runs)
        left = np.concatenate(lefts)[order]
        del runs, lefts
        doc = np.concatenate(least)[order]
        lo, hi = np.concatenate(near)[order].astype(np.int64), np.concatenate(far)[order].astype(np.int64)
        goes = np.zeros((len(order), self.reach + 1), bool)
        left_order = np.argsort(left.view(f"S{self.reach}").ravel(), kind="stable") if self.reach else np.arange(len(left))
        left_shared = common_prefixes(left[left_order])
        del left
        for j in range(self.reach + 1):
            rank = np.empty(len(order), np.int64)
            rank[left_order] = np.cumsum(left_shared < j)
            mine = np.flatnonzero((lo <= j) & (hi >= j))
            if not len(mine):
                continue
            key = np.cumsum(shared < self.span - j)[mine] * np.int64(len(order) + 1) + rank[mine]
            by_key = np.argsort(key, kind="stable")
            key, mine = key[by_key], mine[by_key]
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            group_least = np.minimum.reduceat(doc[mine], starts)
            goes[mine, j] = doc[mine] > np.repeat(group_least, np.diff(np.append(starts, len(mine))))
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        out, at = [], 0
        for block, bucket, size in zip(rows["block"], rows["bucket"], sizes):
            mine = goes[back[at : at + size]]
            at += size
            edges = np.diff(mine.astype(np.int8), axis=1, prepend=0, append=0)
            owner, begin = np.nonzero(edges == 1)
            end = np.nonzero(edges == -1)[1]  # windows begin + 1 - end .. - begin before the anchor
            if len(owner):
                out.append((block, bucket, _pack(owner.astype("<u4"), begin.astype("u1"), end.astype("u1"))))
        return _grouped(out, ["block", "bucket", "payload"])

    def _removed(self, spans: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Starts and ends of the removed windows of a block: those settled at home, then those of each bucket."""
        came = {b.as_py(): payload.as_py() for b, payload in zip(spans["bucket"], spans["payload"])}
        if HOME not in came:
            return
        sent, members, places, gone = _unpack(came.pop(HOME), "<u4", "<u4", "<u4", "<u4")
        yield gone.reshape(2, -1)[0], gone.reshape(2, -1)[1]
        sent = sent.reshape(-1, 2).astype(np.int64)
        row_of = dict(zip(sent[:, 0].tolist(), np.concatenate(([0], np.cumsum(sent[:, 1])))[:-1].tolist()))
        offsets = np.concatenate(([0], np.cumsum(members.astype(np.int64))))
        for bucket, payload in came.items():
            owner, begin, end = (x.astype(np.int64) for x in _unpack(payload, "<u4", "u1", "u1"))
            owner += row_of[bucket]
            times = members[owner].astype(np.int64)
            step = np.arange(times.sum()) - np.repeat(np.concatenate(([0], np.cumsum(times)))[:-1], times)
            where = places[np.repeat(offsets[owner], times) + step].astype(np.int64)
            yield where - np.repeat(end - 1, times), where - np.repeat(begin, times) + self.span

    def cut(self, blocks: pa.Table, spans: pa.Table) -> pa.Table:
        """Each document of a block without the removed bytes, with what was carried beside it."""
        if not blocks.num_rows:
            return pa.table({})
        row = blocks.slice(0, 1).to_pylist()[0]
        raw, ends, ids = _block(row)
        edge = np.zeros(len(raw) + 1, np.int32)
        for a, b in self._removed(spans):
            np.add.at(edge, a, 1)
            np.add.at(edge, b, -1)
        gone = np.cumsum(edge)[:-1] > 0
        n_removed, n_spans, kept, start = [], [], [], 0
        for end in ends.tolist():
            mine = gone[start:end]
            n_removed.append(int(mine.sum()))
            n_spans.append(int(np.count_nonzero(mine[1:] & ~mine[:-1])) + int(len(mine) > 0 and mine[0]))
            left = raw[start:end][~mine].tobytes()
            kept.append(left.decode("utf-8", "ignore") if self.as_text else left)
            start = end
        out = {
            "doc_id": pa.array(ids, pa.int64(), mask=np.frombuffer(row["nulls"], bool)),
            "n_bytes": pa.array(np.diff(ends, prepend=0), pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "n_spans": pa.array(n_spans, pa.int64()),
            "kept": pa.array(kept, pa.string() if self.as_text else pa.binary()),
        }
        if row["beside"]:
            stream = zstandard.ZstdDecompressor().decompress(row["beside"])
            out["carried"] = pa.ipc.open_stream(stream).read_all()["carried"]
        return pa.table(out)


def remove_repeats(
    docs: DataFrame, span: int = SPAN, as_text: bool = False, carried: Column | None = None, **names: str
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept BINARY, and ``carried`` if given.

    ``kept`` is what is left of the UTF-8 bytes; a cut may fall inside a character. With ``as_text``, ``kept`` is
    a string without the parts of characters that were cut in two. ``carried`` is any column of ``docs``, such
    as a struct of its other columns: it stays in the row's block, so no join has to bring it back. A null text is empty;
    a text shorter than ``span`` keeps all. A null id counts as the largest. Rows with one id do not remove
    from each other. An empty table gives no rows. Blocks hold whole documents; a document longer than a
    block is one block.
    """
    spark = docs.sparkSession
    buckets = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = SuffixDedup(span, buckets, as_text)  # Spark counts the parameters of a bound method wrongly, so lambdas
    rows = texts(docs, carried=carried, **names)
    blocks = written(rows.mapInArrow(_to_blocks, BLOCK_SCHEMA), "blocks")
    hashes = blocks.mapInArrow(work.send_hashes, SENT)
    answers = hashes.groupBy("bucket").applyInPandas(lambda rows: work.answer_hashes(rows), SENT)
    by_block = blocks.groupBy("block")
    runs = by_block.cogroup(answers.groupBy("block")).applyInPandas(lambda a, b: work.send_runs(a, b), SENT)
    at_home = F.when(F.col("bucket") == HOME, F.col("block")).alias("home")  # a group for each block
    spans = runs.groupBy("bucket", at_home).applyInPandas(lambda rows: work.merge(rows), SENT)
    schema = StructType.fromDDL("doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint")
    schema.add("kept", StringType() if as_text else BinaryType())
    if carried is not None:
        schema.add("carried", rows.schema["carried"].dataType)
    return by_block.cogroup(spans.groupBy("block")).applyInArrow(lambda a, b: work.cut(a, b), schema)
