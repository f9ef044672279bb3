"""Operator 3, SimHash near-dedup: meet-in-the-middle ball hashing.

Two fingerprints at distance d meet at a variant that lies d div 2 bits from one and the rest from the
other. Every fingerprint emits its ball of radius r = max_bits div 2. For an odd limit the pairs at
distance 2r+1 are missing; such pairs differ in parity, so odd fingerprints alone emit the next shell as well.
Of any three bits two lie in one half of the word, so for shells of two bits those inside a half do:
992 variants in place of 2016. Two balls that share a variant are within the limit by construction, so
a group is linked as a star around its least ball member; no pairs are formed. A group has at
most one member for each variant of the shell, because equal fingerprints count once.

Fingerprints without any neighbour are set aside before the balls are built: a pair within the limit has a
32-bit half within r bits, so both share a half-ball key; and it has three of four 16-bit blocks
within 2 bits, so both share a key of those 48 bits. The first keys are few, the second stay selective when chance
neighbours in 32 bits become common. Keys are only counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weblytics.llm.common import join_counted, texts, written
from weblytics.llm.components import smallest_labels

SEED = 42
NO_ID = (1 << 63) - 1
CHUNK = 1 << 15  # shingles voted on at once


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def simhash(text: bytes, words: int) -> int:
    """Unsigned 64-bit fingerprint of the word shingles of a text; 0 without words."""
    tokens = text.lower().split()  # on bytes: A-Z only, and exactly the six ASCII white spaces
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], spaces + 1))
    ends = np.append(spaces, len(joined))
    width = min(words, len(tokens))
    count = len(tokens) - width + 1
    digest, votes = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, count, CHUNK):
        last = min(count, i + CHUNK)
        cuts = zip(starts[i:last].tolist(), ends[i + width - 1 : last + width - 1].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in cuts], dtype=">u8")
        votes += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > count).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3, name: Column | None = None, **names: str) -> DataFrame:
    """``doc_id, fp BIGINT`` for each row, and ``name BINARY`` if given; a null text has no words."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [
                _signed(simhash(v.as_py() or b"", words)) for v in batch.column(1).cast(pa.binary())
            ]
            yield pa.record_batch(
                [batch.column(0), pa.array(values, pa.int64()), *batch.columns[2:]], names=["doc_id", "fp", *beside]
            )

    beside = [] if name is None else ["name"]
    schema = "doc_id bigint, fp bigint" + "".join(f", {c} binary" for c in beside)
    return texts(docs, carried=name, **names).mapInArrow(mapped, schema)


def _masks(bits: int, first: int = 0, last: int = 64) -> list[int]:
    return [_signed(sum(1 << b for b in c)) for c in combinations(range(first, last), bits)]


def _flips(value: Column, masks: list[int]) -> Column:
    return F.transform(F.lit(masks), lambda m: value.bitwiseXOR(m))


def _odd(value: Column) -> Column:
    return F.bit_count(value) % 2 == 1


def _dealt(known: DataFrame) -> DataFrame:
    """The narrow table over all tasks: its few files would be exploded in as few."""
    return known.repartition(int(known.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")


def _sharing(known: DataFrame, keys: Column, purpose: str) -> DataFrame:
    """The fingerprints that share one of their keys with another."""
    dealt = _dealt(known).select("fp", F.explode(keys).alias("key"))
    shared = written(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1), purpose)
    return written(join_counted(dealt, shared, ["key"]).select("fp").distinct(), purpose)


def _half_keys(max_bits: int) -> Column:
    keys = []
    for half in (0, 1):
        value = F.shiftrightunsigned(F.col("fp"), 32) if half else F.col("fp").bitwiseAND(0xFFFFFFFF)
        tagged = value.bitwiseOR(half << 32)
        near = F.array(tagged)
        if max_bits >= 2:
            near = F.when(_odd(value), F.concat(near, _flips(tagged, _masks(1, 0, 32)))).otherwise(near)
        keys.append(near)
    return F.concat(*keys)


def _block_keys() -> Column:
    """Three blocks of 16 bits, as they are and with one bit flipped, the fourth block holding its number."""
    keys = []
    for left_out in range(4):
        gone = _signed(0xFFFF << (16 * left_out))
        tagged = F.col("fp").bitwiseAND(~gone).bitwiseOR(_signed((left_out + 1) << (16 * left_out)))
        inside = [m for m in _masks(1) if not m & gone]
        keys.append(F.concat(F.array(tagged), _flips(tagged, inside)))
    return F.concat(*keys)


def _with_neighbours(known: DataFrame, max_bits: int) -> DataFrame:
    """The fingerprints that may have a link; all that have one are among them."""
    close = _sharing(known.select("fp"), _half_keys(max_bits), "half-keys")
    return _sharing(close, _block_keys(), "block-keys") if max_bits >= 2 else close


def ball_links(known: DataFrame, max_bits: int = 3) -> DataFrame:
    """``a, b``: links whose closure joins every pair of ``known.fp`` within ``max_bits`` (0 to 3)."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits is 0 to 3")
    radius = max_bits // 2
    ball = [0] + [m for bits in range(1, radius + 1) for m in _masks(bits)]
    known = _dealt(known.select("fp"))
    emitted = known.select("fp", F.lit(True).alias("ball"), F.explode(_flips(F.col("fp"), ball)).alias("variant"))
    if max_bits % 2:
        shell = _masks(1) if radius == 0 else _masks(2, 0, 32) + _masks(2, 32, 64)
        emitted = emitted.unionByName(
            known.where(_odd(F.col("fp"))).select(
                "fp", F.lit(False).alias("ball"), F.explode(_flips(F.col("fp"), shell)).alias("variant")
            )
        )
    group = Window.partitionBy("variant")  # distinct fingerprints: one for each mask at most
    return (
        emitted.withColumn("hub", F.min(F.when(F.col("ball"), F.col("fp"))).over(group))
        .where(F.col("hub").isNotNull() & (F.col("hub") != F.col("fp")))
        .select(F.col("fp").alias("a"), F.col("hub").alias("b"))
        .distinct()
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )


def near_rows(docs: DataFrame, words: int, max_bits: int, name: Column | None = None, **names: str) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fp, component (its least fingerprint's), least id, and ``name`` if given.

    Equal fingerprints are one node; they are joined back with the frequent ones apart.
    """
    rows = written(fingerprints(docs, words, name, **names), "fingerprints")
    known = written(
        rows.groupBy("fp").agg(
            F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("rank"), F.count(F.lit(1)).alias("n")
        ),
        "known",
    )
    close = _with_neighbours(known, max_bits)
    links = ball_links(close, max_bits)
    linked = known.join(close, "fp").select(F.col("fp").alias("node"), "rank")
    labels = smallest_labels(linked, links).select(F.col("node").alias("fp"), "label")
    found = written(
        known.join(labels, "fp", "left").select(
            "fp", "n", F.coalesce("label.rank", "rank").alias("least"), F.coalesce("label.node", "fp").alias("component")
        ),
        "groups",
    )
    return join_counted(rows, found, ["fp"]).drop("n")


def near_groups(docs: DataFrame, words: int = 3, max_bits: int = 3, **names: str) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Null and empty texts have fingerprint zero and are linked like any other. A null id counts as the
    largest: a group of null ids alone has a null component_id. Repeated rows have equal results. An
    empty table gives no rows.
    """
    return near_rows(docs, words, max_bits, **names).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("least") != NO_ID, F.col("least")).alias("component_id"),
    )


def first_names(docs: DataFrame, name: Column, words: int = 3, max_bits: int = 3, **names: str) -> DataFrame:
    """The binary ``name`` of the row that stays of each group: of the least id, null ids last, then the least name."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "name"))
    return near_rows(docs, words, max_bits, name, **names).groupBy("component").agg(first.alias("first")).select("first.name")
