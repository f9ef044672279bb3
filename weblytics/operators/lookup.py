"""Join a large table to values computed once for each distinct key, whatever the key skew."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblytics.session import scratch_dir

BROADCAST_BYTES = 64 << 20
HOT_SHARE = 1000  # a key is hot above 1/1000 of the rows, so there are fewer than 1000 hot keys
SPREAD = 4096


def row_bytes(df: DataFrame) -> Column:
    """Upper estimate of the bytes of one row, for the checks made before a broadcast."""
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns]
    return reduce(lambda a, b: a + b, widths).cast("bigint")


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_distinct_key(
    rows: DataFrame,
    key: str,
    compute: Callable[[DataFrame], DataFrame],
    broadcast_bytes: int = BROADCAST_BYTES,
    staged: bool = False,
) -> DataFrame:
    """Left join ``rows`` to ``compute(distinct keys)`` on the string column ``key``.

    ``compute`` gets ``(key, hits)`` and must return every key once, with both columns. Its result
    is written once, measured, and then joined: broadcast where it is small; otherwise only its hot
    keys are broadcast and the rest is joined by shuffle, the rows of hot and null keys being
    spread because they are settled already. The rows are read twice; ``staged`` writes them
    first, for rows that take a shuffle to make.
    """
    if rows.isStreaming:
        raise ValueError("a stream cannot be read twice; it needs the form without distinct keys")
    if staged:
        rows = _written(rows, "rows")
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("hits"))
    table = _written(compute(counted), "lookup")
    size = table.agg(F.sum(row_bytes(table)).alias("bytes"), F.sum("hits").alias("hits")).first()
    extra = [c for c in table.columns if c not in (key, "hits")]
    if (size["bytes"] or 0) <= broadcast_bytes:
        return rows.join(F.broadcast(table), key, "left").select(*rows.columns, *extra)

    hot = F.col("hits") > size["hits"] / HOT_SHARE
    settled = table.where(hot).select(key, F.struct(*extra).alias("_hot"))
    open_keys = table.where(~hot).select(
        F.concat(F.lit("k"), key).alias("_probe"), F.struct(*extra).alias("_cold")
    )
    # Content hash and partition number, so a re-run task sends each row to the same place,
    # and equal rows of different partitions are still spread.
    salt = F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), F.lit(SPREAD))
    probe = F.when(
        F.col(key).isNotNull() & F.col("_hot").isNull(), F.concat(F.lit("k"), key)
    ).otherwise(F.concat(F.lit("s"), salt.cast("string")))
    joined = (
        rows.join(F.broadcast(settled), key, "left")
        .withColumn("_probe", probe)
        .join(open_keys.hint("merge"), "_probe", "left")
    )
    value = F.coalesce("_hot", "_cold")
    return joined.select(*rows.columns, *[value[c].alias(c) for c in extra])
