"""Operator 1, sharding: a Feistel permutation of global row numbers, with cycle walking.

Rows are numbered from 0 by document id. The permutation of [0, n) is a function of the seed and n
alone: position p = permute(row number), shard = p mod shards, slot = p div shards. So shard sizes
differ by one at most, slots have no gaps, and both can be computed, and inverted, without the data.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblytics.llm.common import numbered, texts

ROUNDS = 6
MULTIPLIER = 0x9E3779B97F4A7C15
STEP = 0xBF58476D1CE4E5B9


def half_bits(n: int) -> int:
    """Bits in each half of the smallest even-width block that holds [0, n)."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def round_keys(seed: int) -> list[int]:
    """Keys in which each bit of the seed reaches all bits, so near seeds share nothing."""
    keys = []
    for i in range(ROUNDS):
        key = (seed * ROUNDS + i + 1) * MULTIPLIER % (1 << 64)
        key = (key ^ key >> 30) * STEP % (1 << 64)
        key = (key ^ key >> 27) * MULTIPLIER % (1 << 64)
        keys.append(key ^ key >> 31)
    return keys


def _network(values: np.ndarray, half: int, keys: list[int]) -> np.ndarray:
    mask, width = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = values >> width, values & mask
    for key in keys:
        mixed = ((right * np.uint64(MULTIPLIER) + np.uint64(key)) >> np.uint64(32)) & mask
        left, right = right, left ^ mixed
    return (right << width) | left  # halves swapped, so the reversed keys undo it


def _walk(values: np.ndarray, n: int, keys: list[int]) -> np.ndarray:
    """Apply the network until each value is back inside [0, n)."""
    half = half_bits(n)
    out = _network(values.astype(np.uint64), half, keys)
    while (outside := out >= np.uint64(n)).any():
        out[outside] = _network(out[outside], half, keys)
    return out.astype(np.int64)


def permute(values: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Row numbers to positions, both in [0, n)."""
    return _walk(np.asarray(values), n, round_keys(seed))


def invert(positions: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Positions back to row numbers; a shard reader finds its rows by this."""
    return _walk(np.asarray(positions), n, round_keys(seed)[::-1])


def position_column(row_number: Column, n: int, seed: int) -> Column:
    @F.pandas_udf("bigint")
    def position(values: pd.Series) -> pd.Series:
        return pd.Series(permute(values.to_numpy(), n, seed))

    return position(row_number)


def shard_rows(rows: DataFrame, order: list[str], shards: int, seed: int) -> DataFrame:
    """``rows`` with ``shard INT`` and ``slot BIGINT``; row numbers follow ``order``, nulls first."""
    counted, n = numbered(rows, order, "shards")
    place = counted.withColumn("_p", position_column(F.col("row_number"), n, seed))
    return place.withColumns(
        {
            "shard": F.pmod("_p", F.lit(shards)).cast("int"),
            "slot": F.expr(f"_p div {int(shards)}"),
        }
    ).drop("_p", "row_number")


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 42, **names: str) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    A null text counts as empty: size 1, crc 0. Null ids come first. Rows with one id are ordered by
    checksum and size; rows equal in these too are interchangeable. An empty table gives no rows.
    The law is ``rows``, so ``grown_shard`` is null. Only these narrow rows are shuffled.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = texts(docs, **names).select(
        "doc_id",
        (F.octet_length(raw) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )
    placed = shard_rows(narrow, ["doc_id", "text_crc32", "size"], shards, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write whole rows, one folder for each shard, files in slot order."""
    (
        sharded.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
