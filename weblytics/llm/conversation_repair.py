"""Operator 11, conversation structure repair: cheapest edits by Viterbi search with coalescing survivors.

The states are those of the automaton of ``(s?(ua)+)?`` over role initials. For each row of a conversation and each
state the cheapest edits that lead there survive, the least audit text among equals. Survivors are leaves of a
backpointer tree whose nodes count their children. A node without children is dropped, one with a single
child is joined with it, and as soon as the root has a single child its edits are common to all survivors: they are
emitted and forgotten. What is held is the part that is still open, as text of one letter for each edit.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import product, zip_longest
from pickle import dump, load
from tempfile import TemporaryFile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weblytics.llm.common import ship

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
USER, ASSISTANT = "user", "assistant"
START, SYSTEM_SEEN, USER_SEEN, ASSISTANT_SEEN = range(4)
ACCEPTED = (START, ASSISTANT_SEEN)
NEXT = {
    (START, "s"): SYSTEM_SEEN, (START, "u"): USER_SEEN, (SYSTEM_SEEN, "u"): USER_SEEN,
    (USER_SEEN, "a"): ASSISTANT_SEEN, (ASSISTANT_SEEN, "u"): USER_SEEN,
}
LEGAL_PAIRS = ("su", "ua", "au")
SPACE = r"\x20\x09-\x0D"
PENDING_BYTES = 8 << 20  # texts of open rows beyond this wait in an unnamed file of the task
DAMAGE_KINDS = 20
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)


# The search

def _moves() -> dict[tuple[str, bool, bool], list[tuple[int, int, int, str]]]:
    """For each kind of row (initial, must go, truncated): (from, to, cost, edits), inserts before the row's own edit."""
    def inserted(state: int) -> list[tuple[int, int, str]]:
        out, cost, text = [(state, 0, "")], 0, ""
        for _ in range(2):  # two inserts return to a state already reached, but from the first two states
            state = next(NEXT[state, x] for x in "ua" if (state, x) in NEXT)
            cost, text = cost + INSERT_COST, text + INSERT
            out.append((state, cost, text))
        return out

    moves = {}
    for initial in ("s", "u", "a", ""):
        for must_go in (False, True):
            for truncated in (False, True):
                least: dict[tuple[int, int], tuple[int, str]] = {}
                extra = TRUNCATED_COST if truncated else 0
                for source in range(4):
                    for state, cost, text in inserted(source):
                        options = [(state, DELETE_COST, DELETE)]
                        if not must_go:
                            if (state, initial) in NEXT:
                                options.append((NEXT[state, initial], extra, KEEP))
                            options += [(NEXT[state, x], REROLE_COST + extra, REROLE) for x in "ua" if (state, x) in NEXT]
                        for target, own, edit in options:
                            found = (cost + own, text + edit)
                            if (source, target) not in least or found < least[source, target]:
                                least[source, target] = found
                moves[initial, must_go, truncated] = [(s, t, c, e) for (s, t), (c, e) in least.items()]
    return moves


MOVES = _moves()
ENDS = [(START, 0, ""), (SYSTEM_SEEN, 2 * INSERT_COST, INSERT * 2), (USER_SEEN, INSERT_COST, INSERT), (ASSISTANT_SEEN, 0, "")]


class Node:
    """A stretch of edits after ``parent``; ``children`` counts the nodes and survivors that hang on it."""

    __slots__ = ("parent", "edits", "children")

    def __init__(self, parent: Node | None, edits: str) -> None:
        self.parent, self.edits, self.children = parent, [edits], 0


def _line(node: Node) -> list[Node]:
    out = [node]
    while out[-1].parent is not None:
        out.append(out[-1].parent)
    return out[::-1]


def _letters(line: list[Node], at: int, tail: str) -> Iterator[str]:
    for node in line[at:]:
        for part in node.edits:
            yield from part
    yield from tail


def _least(a: tuple[Node, str], b: tuple[Node, str]) -> bool:
    """Whether the edits of ``a``, a node and what follows it, are less than those of ``b``.

    Both are compared from the node where they part, letter by letter to their ends if need be. Edits decide the
    state, so those that begin alike share the node, and a difference is found within a row.
    """
    left, right = _line(a[0]), _line(b[0])
    at = 0
    while at < min(len(left), len(right)) and left[at] is right[at]:
        at += 1
    for x, y in zip_longest(_letters(left, at, a[1]), _letters(right, at, b[1]), fillvalue=""):
        if x != y:
            return x < y
    return False


def _detours() -> dict[tuple[int, int], int]:
    """``(state, other)``: the cost at which ``other`` can do whatever ``state`` does from here on.

    By inserting a row, or, in place of a system row kept at the start, by deleting it.
    """
    cost = {(s, o): 0 if s == o else 1 << 30 for s in range(4) for o in range(4)}
    cost[START, ASSISTANT_SEEN] = DELETE_COST
    cost[ASSISTANT_SEEN, START] = cost[SYSTEM_SEEN, ASSISTANT_SEEN] = cost[SYSTEM_SEEN, START] = 0
    for (other, initial), state in NEXT.items():
        if initial != "s":
            cost[state, other] = min(cost[state, other], INSERT_COST)
    for via, state, other in product(range(4), repeat=3):
        cost[state, other] = min(cost[state, other], cost[state, via] + cost[via, other])
    return cost


DETOURS = _detours()


class Search:
    """Edits of one conversation, emitted as soon as all survivors agree on them."""

    def __init__(self, emit: Callable[[str], None]) -> None:
        self.emit = emit
        self.root = Node(None, "")  # what hangs on it is open; what led to it is emitted
        self.root.children = 1
        self.survivors: dict[int, tuple[int, Node]] = {START: (0, self.root)}

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        best: dict[int, tuple[int, Node, str]] = {}
        for source, target, cost, edits in MOVES[initial if initial in ("s", "u", "a") else "", must_go, truncated]:
            if source in self.survivors:
                before, node = self.survivors[source]
                self._offer(best, target, before + cost, node, edits)
        self._settle(best)

    def end(self) -> int:
        """Emit what is left and return the cost."""
        best: dict[int, tuple[int, Node, str]] = {}
        for source, cost, edits in ENDS:
            if source in self.survivors:
                before, node = self.survivors[source]
                self._offer(best, START, before + cost, node, edits)
        cost, node, edits = best[START]
        text = "".join(_letters(_line(node), 0, edits))
        if text:
            self.emit(text)
        return cost

    @staticmethod
    def _offer(best: dict, target: int, cost: int, node: Node, edits: str) -> None:
        if target in best:
            held = best[target]
            if held[0] < cost or (held[0] == cost and not _least((node, edits), held[1:])):
                return
        best[target] = (cost, node, edits)

    def _settle(self, best: dict[int, tuple[int, Node, str]]) -> None:
        """Hang the new survivors on the tree and drop the old ones.

        A state is left out if another one is cheaper by more than it costs to do the same from there: it cannot win.
        """
        fresh = {}
        for target, (cost, node, edits) in best.items():
            if all(cost <= best[other][0] + DETOURS[target, other] for other in best):
                node.children += 1
                leaf = Node(node, edits)
                leaf.children = 1
                fresh[target] = (cost, leaf)
        for _, node in self.survivors.values():
            while node is not None:
                node.children -= 1
                if node.children:
                    break
                node = node.parent
        self.survivors = fresh
        for _, leaf in fresh.values():
            self._join_single(leaf)
        self._agree()

    def _join_single(self, node: Node) -> None:
        """Join nodes on the way to the root that have one child with that child."""
        while node.parent is not None and node.parent is not self.root:
            above = node.parent
            if above.children == 1:
                above.edits.extend(node.edits)
                node.edits, node.parent = above.edits, above.parent
            else:
                node = above

    def _agree(self) -> None:
        """Emit the edits below the root while it has one child."""
        node = next(iter(self.survivors.values()))[1]
        while self.root.children == 1 and node is not self.root:
            child = _line(node)[1]
            self.emit("".join(child.edits))
            child.edits, child.parent = [], None
            self.root = child


class Pending:
    """Rows whose edit is open, in order; beyond ``limit`` bytes they wait in a file without a name."""

    def __init__(self, limit: int = PENDING_BYTES) -> None:
        self.limit, self.held = limit, 0
        self.front: deque[tuple[str, str]] = deque()
        self.file, self.read_at, self.waiting = None, 0, 0

    def put(self, row: tuple[str, str]) -> None:
        if self.waiting or self.held >= self.limit:
            if self.file is None:
                self.file = TemporaryFile()
            self.file.seek(0, 2)
            dump(row, self.file)
            self.waiting += 1
        else:
            self.front.append(row)
            self.held += len(row[1]) + 64

    def take(self) -> tuple[str, str]:
        if not self.front:
            self.held = 0
            self.file.seek(self.read_at)
            while self.waiting and self.held < self.limit:
                row = load(self.file)
                self.front.append(row)
                self.held += len(row[1]) + 64
                self.waiting -= 1
            self.read_at = self.file.tell()
            if not self.waiting:
                self.file.close()
                self.file, self.read_at = None, 0
        row = self.front.popleft()
        self.held -= len(row[1]) + 64
        return row


class Conversation:
    """One conversation as it streams by: ``add`` its rows in order, then ``end``. Repaired rows go to ``put``."""

    def __init__(self, put: Callable[[str, str, str], None]) -> None:
        self.put = put  # (edit, role, text); a deleted row with its own role
        self.search, self.pending = Search(self._edits), Pending()
        self.written, self.system = 0, False
        self.faults = [0, 0, 0, 0]
        self.illegal, self.last = 0, None
        self.least = self.greatest = self.turn = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        self.faults[fault] += 1
        if self.last is not None and self.last + initial not in LEGAL_PAIRS:
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.turn:  # turns ascend
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.greatest = self.turn = turn
        self.pending.put((role, text))
        self.search.row(initial, fault in (BLANK, DUPLICATE), fault == TRUNCATED)

    def end(self) -> tuple[int, int, int, int, int, int]:
        """Gaps, blank, duplicate, truncated, illegal, cost."""
        cost = self.search.end()
        gaps = 0 if self.least is None else self.greatest - self.least + 1 - self.turns
        return gaps, *self.faults[1:], self.illegal, cost

    def _edits(self, edits: str) -> None:
        for edit in edits:
            role, text = ("", "") if edit == INSERT else self.pending.take()
            if edit == KEEP and not self.written and role[:1] == "s":
                self.system = True
            elif edit in (REROLE, INSERT):
                role = ASSISTANT if (self.written - self.system) % 2 else USER
            self.written += edit != DELETE
            self.put(edit, role, text)


# Rows to tasks

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults planted by a hash of ``conv_id:turn``, in which nulls read as one space, as role and text do.

    Columns: conv_id, turn, role, text, copies. A dropped row stays with no copies, so its conversation is still known.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")), F.lit(DAMAGE_KINDS))
    narrow = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"),
    )
    k = F.col("kind")
    return narrow.select(
        "conv_id",
        "turn",
        F.when(k == 0, "").when(k == 4, USER).otherwise(F.col("role")).alias("role"),
        F.when(k.isin(0, 1), "").when(k == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(k == 0, 0).when(k == 3, 2).otherwise(1).alias("copies"),
    )


def _fault(text: Column, seen: Column) -> Column:
    last = F.regexp_extract(text, rf"([^{SPACE}])[{SPACE}]*\z", 1)
    return (
        F.when(last == "", BLANK).when(seen, DUPLICATE).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    )


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Each conversation's rows in order in one partition: conv_id, turn, role, text, fault; a fault of -1 is no row.

    Rows go by turn, nulls first, then by role and text, copies side by side. One exchange serves all: a
    row counts as seen by its place among those of equal role and text, which the same partitioning holds.
    """
    alike = Window.partitionBy("conv_id", "role", "_hash", "_live").orderBy(F.col("turn").asc_nulls_first())
    copies = F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1))))
    spread = (
        rows.repartition("conv_id")
        .withColumn("_live", F.col("copies") > 0)
        .withColumn("_copy", copies)
        .withColumn("_hash", F.sha2("text", 256))
        .withColumn("_seen", F.row_number().over(alike))
        .withColumn("fault", F.when(F.col("_live"), _fault(F.col("text"), F.col("_seen") > 1)).otherwise(-1))
    )
    return spread.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "_seen").select(
        "conv_id", "turn", "role", "text", "fault"
    )


def _streamed(batches: Iterator[pa.RecordBatch], start: Callable, finish: Callable) -> Iterator:
    """Feed sorted rows to one ``Conversation`` after another; what ``finish`` returns for each is yielded."""
    current, key, seen = None, None, False
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(5)]
        for conv_id, turn, role, text, fault in zip(*columns):
            if not seen or conv_id != key:
                if seen:
                    yield finish(key, current)
                current, key, seen = start(conv_id), conv_id, True
            if fault >= 0:
                current.add(turn, role, text, fault)
    if seen:
        yield finish(key, current)


_ROW_KINDS = [("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
_REPORT_KINDS = [
    ("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
    ("audit", pa.string()), ("repaired_sha256", pa.string()),
]
_REPORT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_BATCH_ROWS = 4096


def _batched(rows: Iterator[tuple], kinds: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[k] for r in held], kind) for k, (_, kind) in enumerate(kinds)], names=[n for n, _ in kinds])

    for row in rows:
        held.append(row)
        if len(held) >= _BATCH_ROWS:
            yield batch()
            held.clear()
    if held:
        yield batch()


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ready: deque[tuple] = deque()

    def start(conv_id) -> Conversation:
        place = iter(range(1 << 62))
        return Conversation(lambda edit, role, text: ready.append((conv_id, next(place), edit, role, text)))

    def one_by_one(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for i in range(0, batch.num_rows, _BATCH_ROWS):
                yield batch.slice(i, _BATCH_ROWS)

    def rows() -> Iterator[tuple]:
        for _ in _streamed(one_by_one(batches), start, lambda key, found: found.end()):
            while ready:
                yield ready.popleft()

    return _batched(rows(), _ROW_KINDS)


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    outputs: dict = {}

    def start(conv_id) -> Conversation:
        digest, audit = sha256(), []

        def put(edit: str, role: str, text: str) -> None:
            audit.append(edit)
            if edit != DELETE:
                digest.update((("\n" if outputs["any"] else "") + role + ":" + text).encode())
                outputs["any"] = True

        outputs.update(digest=digest, audit=audit, any=False)
        return Conversation(put)

    def finish(key, found: Conversation) -> tuple:
        counts = found.end()
        return key, *counts, "".join(outputs["audit"]), outputs["digest"].hexdigest()

    return _batched(_streamed(batches, start, finish), _REPORT_KINDS)


def repair(rows: DataFrame) -> DataFrame:
    """Every edit in order: conv_id, place from 0, edit (K, R, D or I), role and text after it; D rows are gone.

    ``rows`` is (conv_id, turn, role, text, copies), as ``damaged`` gives it.
    """
    ship(rows.sparkSession)
    return ordered_rows(rows).mapInArrow(_edited, "conv_id bigint, place bigint, edit string, role string, text string")


def report(rows: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A null conversation is one of its own. Null turns come first and count in no gap. Rows of one turn are ordered by
    role and text. A conversation without rows has zeros, no audit and the hash of no text. An empty table gives no rows;
    other columns are not read. The hash is one chain over all texts of a conversation, so its rows
    stream through one task, however many; held are a stretch of one letter an edit and ``PENDING_BYTES`` of text.
    """
    ship(rows.sparkSession)
    return ordered_rows(rows).mapInArrow(_reports, _REPORT)
