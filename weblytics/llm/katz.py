"""Operator 12, LM scoring: Katz backoff over Good-Turing discounted counts.

Texts become blocks of word numbers, written once. The blocks ask two partitioned tables for counts: words, merged by
their bytes, and pairs of neighbours, merged by a 64-bit hash. What they ask and get travels as sorted, compressed
columns, each distinct word or pair once for a block. A pair that was seen is scored by its discounted count. One
that was not backs off to its last word, with a weight that makes the chances after each first word sum to
one; the weights are a third table, joined to the pairs that backed off.

Order 2: with the contexts of three words the tables alone would be larger than the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblytics.llm.common import UPPER, crc_of_id, join_counted, texts, written

BLOCK_TOKENS = 2_000_000
BUCKET_TOKENS = 500_000  # tokens of the corpus for each bucket of a table
TURING_COUNTS = 5  # counts up to this are discounted by counts of counts
BLOCK_BITS, ROW_BITS = 16, 22  # of a row's name: its block in the partition, its place in the block
WORDS, PAIRS = 0, 1
DOCUMENT, CONTEXT, BACKOFF, STATS = range(4)
END, START = 0, 1  # numbers of the two marks; words follow
MARKS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)  # their hashes
LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())

_BLOCK = "block bigint, tokens bigint, learned bigint, ids binary, flags binary, sizes binary, numbers binary, words binary"
_ASKED = "kind int, bucket bigint, block bigint, payload binary"
_SCORED = "kind int, row bigint, doc_id bigint, learns boolean, n_tokens bigint, n_known bigint, base double, score double, hash bigint, times bigint, seen double, last double, context bigint"


# Columns as bytes

def pack(values: np.ndarray) -> bytes:
    """Integers as compressed planes of bytes, low ones first: planes of zeros cost nothing."""
    wide = np.ascontiguousarray(values, "<u8")
    planes = wide.view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def join_parts(*parts: bytes) -> bytes:
    sizes = np.array([len(p) for p in parts], "<u4")
    return sizes.tobytes() + b"".join(parts)


def split_parts(data: bytes, n: int) -> list[bytes]:
    ends = 4 * n + np.cumsum(np.frombuffer(data[: 4 * n], "<u4"))
    return [data[a:b] for a, b in zip([4 * n, *ends[:-1].tolist()], ends.tolist())]


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first * np.uint64(0xBF58476D1CE4E5B9) ^ (first >> np.uint64(29))
    mixed = (mixed + second) * np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(30))


def bucket_edges(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins: buckets are equal ranges of hashes, so sorted ones lie in bucket order."""
    bounds = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, bounds), [len(sorted_hashes)]]).astype(np.int64)


# The model

def discount(counts: np.ndarray, of_counts: list[int]) -> np.ndarray:
    """Good-Turing discount ratios of counts; ``of_counts[r]`` is how many things occur r times.

    Up to ``TURING_COUNTS`` the ratio is ``(r+1) n[r+1] / (r n[r])`` where that lies between 0 and 1. Beyond, and
    where it does not, counts of counts are taken to fall with the square of r, which gives r / (r + 1). So each
    ratio is below one, and some chance is always left for what was not seen.
    """
    table = np.array([1.0] + [r / (r + 1) for r in range(1, TURING_COUNTS + 1)])
    for r in range(1, TURING_COUNTS + 1):
        if of_counts[r]:
            turing = (r + 1) * of_counts[r + 1] / (r * of_counts[r])
            if 0 < turing < 1:
                table[r] = turing
    counts = np.asarray(counts, np.int64)
    few = table[np.minimum(counts, TURING_COUNTS)]
    return np.where(counts <= TURING_COUNTS, few, counts / (counts + 1.0))


@dataclass(frozen=True)
class Model:
    """What all tasks know: totals and counts of counts, a few numbers whatever the corpus."""

    tokens: int  # in training, with one end for each document
    distinct: int
    documents: int  # in training
    of_words: tuple[int, ...]
    of_pairs: tuple[int, ...]
    unseen: float  # the chance of any word that was not seen

    def word_chance(self, counts: np.ndarray) -> np.ndarray:
        if not self.tokens:
            return np.ones(len(counts))
        seen = discount(counts, list(self.of_words)) * counts / self.tokens
        return np.where(counts > 0, seen, self.unseen)


# Blocks

def _to_blocks(size: int):
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << BLOCK_BITS

        def fresh() -> dict:
            return {"ids": [], "flags": [], "sizes": [], "numbers": [], "tokens": 0, "learned": 0, "words": {}}

        def block(held: dict) -> pa.RecordBatch:
            numbers = np.concatenate(held["numbers"])
            words = list(held["words"])
            order, hashes = _in_hash_order(words)
            place = np.empty(len(words), np.int64)
            place[order] = np.arange(len(words))
            shifted = np.concatenate([[END], place + 2])  # 0 stands for the end, then words in the order of their hash
            packed = zstandard.ZstdCompressor(level=3).compress(b" ".join([words[k] for k in order]))
            ids = held["ids"]
            row = (
                number, held["tokens"], held["learned"],
                np.array([0 if i is None else i for i in ids], "<i8").tobytes(),
                np.array([[i is None, learns] for i, learns in zip(ids, held["flags"])], bool).tobytes(),
                np.array(held["sizes"], "<i8").tobytes(), pack(shifted[numbers].astype(np.uint64)), packed,
            )
            names = [c.split()[0] for c in _BLOCK.split(", ")]
            kinds = [pa.int64()] * 3 + [pa.binary()] * 5
            return pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        held = fresh()
        for batch in batches:
            for doc_id, text, learns in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2).to_pylist()):
                words = (text.as_py() or b"").translate(LOWER).split()
                known = held["words"]
                numbers = [known.setdefault(w, len(known)) + 1 for w in words]
                numbers.append(END)
                held["numbers"].append(np.array(numbers, np.int64))
                held["ids"].append(doc_id)
                held["flags"].append(learns)
                held["sizes"].append(len(numbers))
                held["tokens"] += len(numbers)
                held["learned"] += len(numbers) if learns else 0
                if held["tokens"] >= size or len(held["ids"]) >> ROW_BITS:
                    yield block(held)
                    held, number = fresh(), number + 1
        if held["ids"]:
            yield block(held)

    return mapped


def _in_hash_order(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    order = np.argsort(hashes, kind="stable")
    return order, hashes[order]


class Block:
    """A stored block: its documents and token numbers, and its words in the order of their hash."""

    def __init__(self, row: dict) -> None:
        self.number = row["block"]
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.no_id, self.learns = np.frombuffer(row["flags"], bool).reshape(-1, 2).T
        self.sizes = np.frombuffer(row["sizes"], "<i8")
        self.tokens = unpack(row["numbers"]).astype(np.int64)
        self.words = zstandard.ZstdDecompressor().decompress(row["words"]).split(b" ") if row["words"] else []
        if self.words == [b""]:
            self.words = []
        self.word_hashes = _in_hash_order(self.words)[1] if self.words else np.zeros(0, np.uint64)
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[starts] = START

    def hashes(self) -> np.ndarray:
        """Of the marks, then of the words."""
        return np.concatenate([MARKS, self.word_hashes])

    def word_counts(self) -> np.ndarray:
        """How often each word occurs in training documents of the block."""
        return np.bincount(self.tokens[self.learns[self.owner]], minlength=len(self.words) + 2)[2:]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs in the order of their hash: hash, first, second, and each token's place among them.

        Pairs of one hash stay apart here; the table counts them together.
        """
        width = len(self.words) + 2
        distinct, inverse = np.unique(self.before * width + self.tokens, return_inverse=True)
        first, second = distinct // width, distinct % width
        known = self.hashes()
        hashes = pair_hash(known[first], known[second])
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return hashes[order], first[order], second[order], place[inverse]


def _asking(buckets: int):
    """For each block and bucket: the words asked with their counts, and the pairs with theirs."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, out = Block(row), []
                counts = block.word_counts()
                edges = bucket_edges(block.word_hashes, buckets)
                for b in range(buckets):
                    a, z = edges[b], edges[b + 1]
                    if z > a:
                        packed = zstandard.ZstdCompressor(level=3).compress(b" ".join(block.words[a:z]))
                        out.append((WORDS, b, block.number, join_parts(packed, pack(counts[a:z]))))
                hashes, _, _, place = block.pairs()
                counts = np.bincount(place[block.learns[block.owner]], minlength=len(hashes))
                edges = bucket_edges(hashes, buckets)
                for b in range(buckets):
                    a, z = edges[b], edges[b + 1]
                    if z > a:
                        out.append((PAIRS, b, block.number, join_parts(pack_sorted(hashes[a:z]), pack(counts[a:z]))))
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.record_batch(
                    [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)],
                    names=["kind", "bucket", "block", "payload"],
                )

    return mapped


# Tables

def _merged_words(payloads: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Total of each asked word, as asked, and all totals once."""
    asked, totals = [], {}
    for payload in payloads:
        packed, counts = split_parts(payload, 2)
        words = zstandard.ZstdDecompressor().decompress(packed).split(b" ")
        asked.append(words)
        for word, n in zip(words, unpack(counts).tolist()):
            totals[word] = totals.get(word, 0) + n
    return [np.array([totals[w] for w in words], np.uint64) for words in asked], np.array(list(totals.values()), np.int64)


def _merged_pairs(payloads: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Twice the total of each asked pair, plus one where the asking block is to answer for the pair."""
    parts = [split_parts(p, 2) for p in payloads]
    hashes = [unpack_sorted(p[0]) for p in parts]
    ends = np.cumsum([len(x) for x in hashes])
    every, counts = np.concatenate(hashes), np.concatenate([unpack(p[1]) for p in parts]).astype(np.int64)
    order = np.argsort(every, kind="stable")
    every, counts = every[order], counts[order]
    new = np.concatenate([[True], every[1:] != every[:-1]])
    run = np.cumsum(new) - 1
    totals = np.bincount(run, weights=counts, minlength=run[-1] + 1).astype(np.int64)
    learned = np.flatnonzero(counts > 0)
    answers = np.zeros(len(every), np.uint64)
    answers[learned[np.unique(run[learned], return_index=True)[1]]] = 1  # the first block that learned it
    answers += (2 * totals[run]).astype(np.uint64)
    back = np.empty_like(answers)
    back[order] = answers
    return np.split(back, ends[:-1]), totals


def _answer(rows: pa.Table) -> pa.Table:
    """One bucket of one table: answers to the blocks, and a row of statistics."""
    kind, bucket = rows["kind"][0].as_py(), rows["bucket"][0].as_py()
    rows = rows.sort_by("block")
    merge = _merged_words if kind == WORDS else _merged_pairs
    answers, totals = merge(rows["payload"].to_pylist())
    of_counts = np.bincount(np.minimum(totals, TURING_COUNTS + 2), minlength=TURING_COUNTS + 3)
    many = totals[totals > TURING_COUNTS].astype(float)
    stats = np.array([*of_counts, totals.sum(), (many * discount(many, [0] * (TURING_COUNTS + 2))).sum()], "<f8").tobytes()
    blocks = rows["block"].to_pylist()
    n = len(blocks)
    return pa.table({
        "kind": pa.array([kind] * n + [STATS + kind], pa.int32()),
        "bucket": pa.array([bucket] * (n + 1), pa.int64()),
        "block": pa.array([*blocks, -1], pa.int64()),
        "payload": pa.array([*[pack(a) for a in answers], stats], pa.binary()),
    })


@dataclass(frozen=True)
class Totals:
    """Of one table: how many things occur r times (the last for all beyond), all counts, those beyond after discount."""

    of_counts: tuple[int, ...]
    total: int
    kept: float


def _totals(answers: DataFrame, kind: int) -> Totals:
    """The statistics of all buckets, summed in tasks."""
    width = TURING_COUNTS + 5

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for value in batch.column(0).to_pylist():
                total += np.frombuffer(value, "<f8")
        yield pa.record_batch([pa.array([t]) for t in total], names=[f"s{k}" for k in range(width)])

    parts = answers.where(F.col("kind") == STATS + kind).select("payload")
    summed = parts.mapInArrow(mapped, ", ".join(f"s{k} double" for k in range(width)))
    found = [v or 0.0 for v in summed.agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(width)]).first()]
    return Totals(tuple(int(v) for v in found[:-2]), int(found[-2]), found[-1])


# Scores

def _scoring(model: Model):
    """Score a block with the answers to it; what needs a backoff weight goes out by its first word."""
    kinds = [
        pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(),
        pa.int64(), pa.float64(), pa.float64(), pa.int64(),
    ]
    names = [c.split()[0] for c in _SCORED.split(", ")]

    def batch(kind: int, n: int, **columns) -> pa.RecordBatch:
        arrays = [pa.array(np.full(n, kind, np.int32))]
        arrays += [columns[c] if c in columns else pa.nulls(n, t) for c, t in zip(names[1:], kinds[1:])]
        return pa.record_batch([a if isinstance(a, pa.Array) else pa.array(a).cast(t) for a, t in zip(arrays, kinds)], names=names)

    def scored(stored: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(stored.to_pylist()[0])
        ordered = answers.sort_by([("kind", "ascending"), ("bucket", "ascending")])
        parts: dict[int, list[np.ndarray]] = {WORDS: [], PAIRS: []}
        for kind, payload in zip(ordered["kind"].to_pylist(), ordered["payload"].to_pylist()):
            parts[kind].append(unpack(payload))
        of_word = np.concatenate([[model.documents, model.documents], *[p.astype(np.int64) for p in parts[WORDS]]])
        answer = np.concatenate(parts[PAIRS]).astype(np.int64)
        together, answers_for = answer >> 1, (answer & 1).astype(bool)
        hashes, first, second, place = block.pairs()
        chance = model.word_chance(of_word)
        context = of_word[first]
        kept = discount(together, list(model.of_pairs)) * together
        seen = together > 0
        # Chances of the pairs that this block answers for, summed by first word, and those of their last words.
        pairs = np.flatnonzero(answers_for & seen)
        mass = np.bincount(first[pairs], weights=kept[pairs], minlength=len(of_word))
        last = np.bincount(first[pairs], weights=chance[second[pairs]], minlength=len(of_word))
        told = np.flatnonzero(mass > 0)
        known = block.hashes().view(np.int64)
        log = np.where(seen, np.log10(np.where(seen, kept, 1) / np.maximum(context, 1)), np.log10(chance[second]))
        n = len(block.sizes)
        total = lambda values: np.bincount(block.owner, weights=values, minlength=n)
        base = np.log10((of_word + 1.0) / (model.tokens + model.distinct + 1))
        rows = (np.int64(block.number) << ROW_BITS) + np.arange(n)
        out = [
            batch(
                DOCUMENT, n, row=rows, doc_id=pa.array(block.ids, mask=block.no_id), learns=block.learns.copy(),
                n_tokens=block.sizes, n_known=total(of_word[block.tokens] > 0).astype(np.int64),
                base=total(base[block.tokens]), score=total(log[place]),
            ),
            batch(CONTEXT, len(told), hash=known[told], seen=mass[told], last=last[told], context=of_word[told]),
        ]
        weighed = np.flatnonzero((~seen & (context > 0))[place])  # backing off from a known word takes its weight
        keys, times = np.unique(block.owner[weighed] * np.int64(len(of_word)) + block.before[weighed], return_counts=True)
        out.append(batch(BACKOFF, len(keys), row=rows[keys // len(of_word)], hash=known[keys % len(of_word)], times=times))
        return pa.Table.from_batches(out)

    return scored


def score_documents(docs: DataFrame, learns: Column, block_tokens: int = BLOCK_TOKENS, bucket_tokens: int = BUCKET_TOKENS, **names: str) -> DataFrame:
    """One row for each row of ``docs``: doc_id, learns, n_tokens, n_known, train_tokens, base_score, score.

    ``learns`` is a condition on ``doc_id``; null counts as false. A null or empty text is one token, the end. Null and
    repeated ids and repeated rows are learned from and scored like others, each row by itself. If nothing is
    learned every score is 0. An empty table gives no rows. Texts are read whole. The logarithms are to base 10.

    Counts are exact for words. Pairs, and the first words of backoff weights, are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    source = texts(docs, **names).select("doc_id", "text", F.coalesce(learns, F.lit(False)).alias("learns"))
    blocks = written(source.mapInArrow(_to_blocks(block_tokens), _BLOCK), "katz-blocks")
    sums = blocks.agg(F.sum("tokens").alias("tokens"), F.sum("learned").alias("learned")).first()
    buckets = max(1, -(-(sums["tokens"] or 0) // bucket_tokens))
    asked = blocks.mapInArrow(_asking(buckets), _ASKED)
    answers = written(asked.groupBy("kind", "bucket").applyInArrow(_answer, _ASKED), "katz-answers")
    model = _model(_totals(answers, WORDS), _totals(answers, PAIRS), sums["learned"] or 0)
    to_block = answers.where(F.col("kind").isin(WORDS, PAIRS))
    found = written(
        blocks.groupBy("block").cogroup(to_block.groupBy("block")).applyInArrow(_scoring(model), _SCORED), "katz-scores"
    )
    contexts = (
        found.where(F.col("kind") == CONTEXT).groupBy("hash")
        .agg(F.sum("seen").alias("kept"), F.sum("last").alias("last"), F.max("context").alias("of"))
        .select("hash", F.log10((1 - F.col("kept") / F.col("of")) / (1 - F.col("last"))).alias("weight"))
    )
    open_pairs = found.where(F.col("kind") == BACKOFF).select("hash", "row", "times")
    weights = contexts.join(open_pairs.groupBy("hash").agg(F.count(F.lit(1)).alias("n")), "hash")
    paid = join_counted(open_pairs, weights, ["hash"]).groupBy("row").agg(F.sum(F.col("times") * F.col("weight")).alias("paid"))
    documents = found.where(F.col("kind") == DOCUMENT).select("row", "doc_id", "learns", "n_tokens", "n_known", "base", "score")
    return documents.join(paid, "row", "left").select(
        "doc_id", "learns", "n_tokens", "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"),
        (F.col("score") + F.coalesce("paid", F.lit(0.0))).alias("score"),
    )


def _model(words: Totals, pairs: Totals, tokens: int) -> Model:
    """The end counts as a word, once for each training document."""
    documents = tokens - words.total
    counts, kept = list(words.of_counts), words.kept
    if documents:
        counts[min(documents, TURING_COUNTS + 2)] += 1
        kept += float(documents * discount(np.array([documents]), [0] * (TURING_COUNTS + 2))[0]) if documents > TURING_COUNTS else 0
    few = np.arange(TURING_COUNTS + 1)
    kept += float((few * np.array(counts[: TURING_COUNTS + 1]) * discount(few, counts)).sum())
    return Model(tokens, sum(counts[1:]), documents, tuple(counts), pairs.of_counts, 1 - kept / max(tokens, 1))


def learned_documents(doc_id: Column) -> Column:
    """The fold of training: CRC-32 of the id in decimal is not 2 modulo 7."""
    return F.pmod(crc_of_id(doc_id), F.lit(7)) != 2
