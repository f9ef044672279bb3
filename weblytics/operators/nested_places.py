"""Flattening of IP ranges that lie inside each other or overlap, so that each address has one place.

Registries hold ranges inside ranges: a provider's block, a customer's part of it. The narrowest range that
covers an address wins; of equally narrow ones the one that starts later, then the greater place. This is
total, so partial overlaps are defined as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblytics.operators.places import BLOCK_BITS, FINE_BITS, cut_ranges
from weblytics.schema import PLACE_COLUMNS
from weblytics.session import scratch_dir, ship_package

PIECES = "start_ip bigint, end_ip bigint, country string, province string"
DENSE_PIECES = 1 << 16  # pieces of a /16 block above which it is swept by /24 blocks


def sweep(ranges: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """``(first, last, owner)`` of the stretches of one block, from ``(first, last, rank, owner)``.

    Starts and ends are passed in order. The open ranges are a heap with the winner, of least rank, on top;
    ended ones are dropped when they reach the top. Neighbouring stretches of one owner are one.
    """
    ranges.sort()
    open_ranges: list[tuple[int, int, int]] = []  # rank, owner, last
    at, k, held = 0, 0, None
    while k < len(ranges) or open_ranges:
        while open_ranges and open_ranges[0][2] < at:
            heappop(open_ranges)
        if not open_ranges:
            if k == len(ranges):
                break
            at = max(at, ranges[k][0])
        while k < len(ranges) and ranges[k][0] <= at:
            first, last, rank, owner = ranges[k]
            heappush(open_ranges, (rank, owner, last))
            k += 1
        while open_ranges and open_ranges[0][2] < at:
            heappop(open_ranges)
        if not open_ranges:
            continue
        _, owner, last = open_ranges[0]
        until = min(last, ranges[k][0] - 1) if k < len(ranges) else last
        if held is not None and held[2] == owner and held[1] + 1 == at:
            held = (held[0], until, owner)
        else:
            if held is not None:
                yield held
            held = (at, until, owner)
        at = until + 1
    if held is not None:
        yield held


def _swept(block: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one block without overlap."""
    places = [tuple(None if pd.isna(v) else v for v in row) for row in block[list(PLACE_COLUMNS)].itertuples(index=False)]
    order = sorted(range(len(block)), key=lambda i: [(v is not None, v or "") for v in places[i]], reverse=True)
    order.sort(key=lambda i: -block["start_ip"].iat[i])
    order.sort(key=lambda i: block["width"].iat[i])
    rank = [0] * len(order)
    for r, i in enumerate(order):
        rank[i] = r
    pieces = zip(block["_first"].tolist(), block["_last"].tolist(), rank, range(len(block)))
    rows = [(first, last, *places[owner]) for first, last, owner in sweep(list(pieces))]
    return pd.DataFrame(rows, columns=["start_ip", "end_ip", *PLACE_COLUMNS])


def flat_ranges(ranges: DataFrame, dense_pieces: int = DENSE_PIECES) -> DataFrame:
    """``ranges`` without overlaps, cut at /16 borders, for ``with_places``.

    Each range is cut at the borders of /16 blocks, and each block is swept by itself. Equal ranges of equal place are
    one first. A block with more than ``dense_pieces`` pieces is cut again at /24 and swept in 256 parts.
    Ranges without a bound or that end before they start are refused, as ``with_places`` refuses them.
    """
    distinct = ranges.select("start_ip", "end_ip", *PLACE_COLUMNS).distinct()
    bad = distinct.where(F.coalesce(F.col("start_ip") > F.col("end_ip"), F.lit(True))).count()
    if bad:
        raise ValueError(f"{bad} IP ranges lack a bound or end before they start")
    sized = distinct.withColumn("width", F.col("end_ip") - F.col("start_ip"))
    kept = ["start_ip", "width", *PLACE_COLUMNS]
    coarse = cut_ranges(sized, "start_ip", "end_ip", BLOCK_BITS, kept)
    dense = coarse.groupBy("_block").count().where(F.col("count") > dense_pieces).select("_block")  # 65,536 at most
    sparse = coarse.join(F.broadcast(dense), "_block", "left_anti").withColumn("_bits", F.lit(BLOCK_BITS))
    fine = cut_ranges(coarse.join(F.broadcast(dense), "_block", "left_semi"), "_first", "_last", FINE_BITS, kept)
    pieces = sparse.unionByName(fine.withColumn("_bits", F.lit(FINE_BITS)))
    spark, path = ranges.sparkSession, scratch_dir(ranges.sparkSession, "flat-ranges")
    ship_package(spark)
    pieces.groupBy("_bits", "_block").applyInPandas(_swept, PIECES).write.parquet(path)  # it is read several times
    return spark.read.schema(PIECES).parquet(path)
