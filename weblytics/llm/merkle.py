"""Operator 13, Merkle dataset manifest: hash trees kept as aligned subtrees in van Emde Boas order.

The leaves of each group are numbered in their order and cut into aligned blocks of ``2 ** BLOCK_LEVELS``. A block
is one subtree. Its nodes lie in van Emde Boas order: a tree is split at half its height into a top tree and its
bottom trees, each laid out by the same rule, so a path from leaf to root touches few stretches of memory whatever the
cache. The block roots are the leaves of the next round, until one block is left; the roots of the groups are the
leaves of one last tree. Proofs go the other way: a block gets the path above its root and adds its own siblings.

No task holds more than a block, however many rows a group has.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weblytics.llm.common import INDEX_BITS, crc_of_id, ship, written

BLOCK_LEVELS = 10  # a full block has 1024 leaves
DIGEST = 32
STEP = DIGEST + 1  # of a path: where the sibling is, then its digest
NONE, RIGHT, LEFT = 0, 1, 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NO_GROUP, SOME_GROUP = "-", "="  # a null group comes before all others

_BLOCK = "g string, block bigint, blocks bigint, levels int, n int, keys array<string>, claims array<binary>, nodes binary, root binary"
_PATH = "g string, idx bigint, path binary, subroot binary"
_PROOF = "key string, leaf binary, subroot binary, proof binary, folded binary"


# Address arithmetic

def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places of nodes ``index`` of one ``depth`` (the root has 0) in a tree of ``levels`` node levels."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(depth, index, top)
    bottom, below = levels - top, depth - top
    first = (1 << top) - 1 + (index >> below) * ((1 << bottom) - 1)
    return first + address(below, index & ((1 << below) - 1), bottom)


@cache
def _level_addresses(depth: int, levels: int) -> np.ndarray:
    return address(depth, np.arange(1 << depth, dtype=np.int64), levels)


def level_sizes(n: int, levels: int) -> list[int]:
    """Nodes of each depth of a tree over its first ``n`` leaves: a run of two, or a last one alone, has one parent."""
    return [-(-n >> (levels - 1 - depth)) for depth in range(levels)]


def parent(*digests: bytes) -> bytes:
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def build(leaves: list[bytes], levels: int) -> bytes:
    """The nodes over ``leaves`` in van Emde Boas order; places without a node are zero."""
    nodes = np.zeros(((1 << levels) - 1, DIGEST), np.uint8)
    row = leaves
    for depth in range(levels - 1, -1, -1):
        nodes[_level_addresses(depth, levels)[: len(row)]] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, DIGEST)
        row = [parent(*row[i : i + 2]) for i in range(0, len(row), 2)]
    return nodes.tobytes()


class Block:
    """A stored subtree."""

    def __init__(self, nodes: bytes, n: int, levels: int) -> None:
        self.nodes, self.n, self.levels = nodes, n, levels
        self.sizes = level_sizes(n, levels)
        self.places = [(_level_addresses(d, levels) * DIGEST).tolist() for d in range(levels)]

    def node(self, depth: int, index: int) -> bytes:
        at = self.places[depth][index]
        return self.nodes[at : at + DIGEST]

    def path(self, index: int) -> bytes:
        """The siblings from leaf ``index`` up to this block's root."""
        steps = []
        for depth in range(self.levels - 1, 0, -1):
            sibling = index ^ 1
            if sibling >= self.sizes[depth]:
                steps.append(bytes(STEP))
            else:
                steps.append(bytes((LEFT if sibling < index else RIGHT,)) + self.node(depth, sibling))
            index >>= 1
        return b"".join(steps)


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path give."""
    for at in range(0, len(path), STEP):
        side, sibling = path[at], path[at + 1 : at + STEP]
        leaf = parent(leaf) if side == NONE else parent(sibling, leaf) if side == LEFT else parent(leaf, sibling)
    return leaf


def siblings(path: bytes) -> list[bytes]:
    return [path[at + 1 : at + STEP] for at in range(0, len(path), STEP) if path[at] != NONE]


# Construction

def _batch(rows: list[tuple], ddl_kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(ddl_kinds)], names=[n for n, _ in ddl_kinds]
    )


_BLOCK_KINDS = [
    ("g", pa.string()), ("block", pa.int64()), ("blocks", pa.int64()), ("levels", pa.int32()), ("n", pa.int32()),
    ("keys", pa.list_(pa.string())), ("claims", pa.list_(pa.binary())), ("nodes", pa.binary()), ("root", pa.binary()),
]
_PATH_KINDS = [("g", pa.string()), ("idx", pa.int64()), ("path", pa.binary()), ("subroot", pa.binary())]
_PROOF_KINDS = [("key", pa.string()), *[(c, pa.binary()) for c in ("leaf", "subroot", "proof", "folded")]]


def _blocks(leaves: DataFrame, height: int) -> DataFrame:
    """One row for each block from ``(g, idx, total, node, key, claim)``, written: a round of the manifest."""

    def built(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("idx")
        total = rows["total"][0].as_py()
        blocks = -(-total >> height)
        levels = 1 + (height if blocks > 1 else (total - 1).bit_length())
        nodes = build(rows["node"].to_pylist(), levels)
        row = (
            rows["g"][0].as_py(), rows["idx"][0].as_py() >> height, blocks, levels, rows.num_rows,
            rows["key"].to_pylist(), rows["claim"].to_pylist(), nodes, nodes[:DIGEST],
        )
        return pa.Table.from_batches([_batch([row], _BLOCK_KINDS)])

    block = F.shiftright("idx", height).alias("block")
    return written(leaves.groupBy("g", block).applyInArrow(built, _BLOCK), "merkle-blocks")


def _indexed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``idx`` from 0 and ``total`` for each ``g``, in the order of ``order``; rows equal in it keep any order.

    Rows are sorted by range over all groups. What is counted is one row for each partition and group that meet,
    at most partitions plus groups; its join is by partition and group, so a large group is not gathered.
    """
    keys = ["g", *order]
    stored = written(
        rows.withColumn("_place", F.monotonically_increasing_id())
        .repartitionByRange(*keys, "_place")
        .sortWithinPartitions(*keys, "_place")
        .drop("_place")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << INDEX_BITS) - 1)),
        "merkle-order",
    )
    met = stored.groupBy("_part", "g").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    of_group = Window.partitionBy("g")
    before = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(
        met.select(
            "_part", "g", F.sum("_n").over(of_group).alias("total"),
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        ),
        "merkle-starts",
    )
    return stored.join(starts, ["_part", "g"]).withColumn("idx", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def _rounds(leaves: DataFrame, height: int) -> list[DataFrame]:
    """Tables of blocks, from the leaves up; the last one has one block for each group that reached it."""
    rounds = [_blocks(leaves, height)]
    while (rounds[-1].agg(F.max("blocks")).first()[0] or 0) > 1:
        below = rounds[-1].where("blocks > 1")
        rounds.append(_blocks(below.select(
            "g", F.col("block").alias("idx"), F.col("blocks").alias("total"), F.col("root").alias("node"),
            F.lit(None).cast("string").alias("key"), F.lit(None).cast("binary").alias("claim"),
        ), height))
    return rounds


def _tops(rounds: list[DataFrame]) -> DataFrame:
    """``(g, root)`` of every group."""
    return reduce(DataFrame.unionByName, [r.where("blocks = 1").select("g", "root") for r in rounds])


# Retrieval

def _child_paths(blocks: DataFrame, height: int) -> DataFrame:
    """The path of each leaf of the blocks."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, first = Block(row["nodes"], row["n"], row["levels"]), row["block"] << height
                rows = [(row["g"], first + i, block.path(i) + row["path"], row["subroot"]) for i in range(block.n)]
                yield _batch(rows, _PATH_KINDS)

    return blocks.mapInArrow(mapped, _PATH)


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            block, out = Block(row["nodes"], row["n"], row["levels"]), []
            for i in range(block.n):
                leaf, path = block.node(block.levels - 1, i), block.path(i) + row["path"]
                claim = leaf if row["claims"][i] is None else row["claims"][i]
                out.append((row["keys"][i], leaf, row["subroot"], parent(*siblings(path)), fold(claim, path)))
            yield _batch(out, _PROOF_KINDS)


def _with_paths(rounds: list[DataFrame], above: DataFrame, height: int) -> DataFrame:
    """The blocks of the first round with the path from their root up, and the root of their group.

    ``above`` is ``(g, path, subroot)``, the path of each group's root.
    """
    upper = None
    for blocks in reversed(rounds):
        placed = blocks.where("blocks = 1").join(above, "g")
        if upper is not None:
            beneath = _child_paths(upper, height).withColumnRenamed("idx", "block")
            placed = placed.unionByName(blocks.where("blocks > 1").join(beneath, ["g", "block"]))
        upper = placed
    return upper


@dataclass
class Manifest:
    """The stored trees: rounds of blocks under each group's root, and rounds over those roots."""

    rounds: list[DataFrame]
    top_rounds: list[DataFrame]
    root: bytes | None  # None of no rows
    height: int

    def proofs(self) -> DataFrame:
        """One row for each leaf: key, leaf, subroot, proof (the hash of its siblings) and folded.

        ``folded`` is the root that the claimed leaf gives with the stored siblings.
        """
        spark = self.rounds[0].sparkSession
        nothing = spark.createDataFrame([("", b"", b"")], "g string, path binary, subroot binary")
        to_groups = _with_paths(self.top_rounds, nothing, self.height).mapInArrow(_top_paths, "g string, path binary")
        above = to_groups.join(_tops(self.rounds).withColumnRenamed("root", "subroot"), "g")
        return _with_paths(self.rounds, above, self.height).mapInArrow(_proofs, _PROOF)


def _top_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of the groups' roots, by the name of the group."""
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row["nodes"], row["n"], row["levels"])
            rows = [(row["keys"][i], block.path(i) + row["path"]) for i in range(block.n)]
            yield _batch(rows, [("g", pa.string()), ("path", pa.binary())])


def manifest(leaves: DataFrame, height: int = BLOCK_LEVELS) -> Manifest:
    """Build the trees, in blocks of ``2 ** height`` leaves, over ``(g, doc_id, leaf, claim)``; leaves ascend by id, then by digest, nulls first.

    ``leaf`` and ``claim`` are binary digests. ``claim`` is what a holder says the leaf is, null for the leaf itself.
    """
    ship(leaves.sparkSession)
    stored = written(leaves.select("g", "doc_id", "leaf", "claim"), "merkle-leaves")
    numbered = _indexed(stored, ["doc_id", "leaf"]).select(
        "g", "idx", "total", F.col("leaf").alias("node"), F.col("doc_id").cast("string").alias("key"), "claim"
    )
    rounds = _rounds(numbered, height)
    groups = _tops(rounds).select(F.lit("").alias("g"), F.col("g").alias("name"), "root")
    top = _indexed(groups, ["name"]).select(
        "g", "idx", "total", F.col("root").alias("node"), F.col("name").alias("key"), F.lit(None).cast("binary").alias("claim")
    )
    top_rounds = _rounds(top, height)
    found = _tops(top_rounds).first()  # the group of all groups has one root
    return Manifest(rounds, top_rounds, None if found is None else bytes(found["root"]), height)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of the fields, each with its length in bytes; a null is a dash."""
    return F.unhex(F.sha2(F.concat(*[_field(f) for f in fields]), 256))


def group_key(group: Column) -> Column:
    """A group as text that is never null and sorts as the group does, nulls first."""
    return F.when(group.isNull(), F.lit(NO_GROUP)).otherwise(F.concat(F.lit(SOME_GROUP), group.cast("string")))


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """Leaves of the documents by language; where ``tampered``, the claim has one more in ``n_chars``."""
    fields = {c: F.col(c) for c in FIELDS} | {"doc_id": F.col("doc_id").cast("bigint"), "n_chars": F.col("n_chars").cast("bigint")}
    changed = fields | {"n_chars": fields["n_chars"] + 1}
    touched = tampered & F.col("n_chars").isNotNull()
    return docs.select(
        group_key(F.col("lang")).alias("g"),
        fields["doc_id"].alias("doc_id"),
        leaf_digest(*fields.values()).alias("leaf"),
        F.when(touched, leaf_digest(*changed.values())).alias("claim"),
    )


def tampered_documents() -> Column:
    """Where 7 divides the CRC-32 of the id in decimal. A null id is left alone."""
    return F.col("doc_id").isNotNull() & (F.pmod(crc_of_id(F.col("doc_id").cast("bigint")), F.lit(7)) == 0)


def check_documents(docs: DataFrame, height: int = BLOCK_LEVELS) -> DataFrame:
    """One row for each document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Null values are written as a dash; a null language is a group of its own, before the others. Null ids come first in
    their group and are not tampered with; rows of one id are ordered by their digests, and equal rows are
    interchangeable. Texts are hashed whole. Columns beyond ``FIELDS`` are not read. An empty table gives no rows.
    """
    trees = manifest(document_leaves(docs, tampered_documents()), height)
    root = F.lit("" if trees.root is None else trees.root.hex())
    hexed = lambda c: F.lower(F.hex(c))
    return trees.proofs().select(
        F.col("key").cast("bigint").alias("doc_id"),
        hexed("leaf").alias("leaf"),
        hexed("subroot").alias("subroot"),
        root.alias("root"),
        hexed("proof").alias("proof_sha256"),
        hexed("folded").alias("folded_root"),
        (hexed("folded") == root).alias("verified"),
    )
