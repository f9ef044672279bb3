"""Country and province of each hit, from a table of IPv4 ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weblytics.functions.text import ip_number
from weblytics.operators.lookup import BROADCAST_BYTES, by_distinct_key, row_bytes
from weblytics.schema import PLACE_COLUMNS

BLOCK_BITS = 16
FINE_BITS = 8
WIDEST_BLOCK = 256  # pieces of a /16 block above which it is cut at /24; a /24 block has no more


def _block(number: Column, bits: int = BLOCK_BITS) -> Column:
    return F.shiftright(number, bits)


def cut_ranges(
    ranges: DataFrame, start: str, end: str, bits: int, kept: Sequence[str] = PLACE_COLUMNS
) -> DataFrame:
    """Ranges cut at the borders of blocks of ``bits`` bits; without block if the bounds are no range."""
    blocks = F.when(F.col(start) <= F.col(end), F.sequence(_block(F.col(start), bits), _block(F.col(end), bits)))
    first = F.shiftleft(F.col("_cut_block"), bits)
    return ranges.select("*", F.explode_outer(blocks).alias("_cut_block")).select(
        F.col("_cut_block").alias("_block"),
        F.greatest(start, first).alias("_first"),
        F.least(end, first + ((1 << bits) - 1)).alias("_last"),
        *kept,
    )


def range_pieces(ranges: DataFrame) -> DataFrame:
    """Each range cut at /16 borders: at most 65,536 pieces for one range.

    A range without start or end, or with its end before its start, gives one piece without block.
    """
    return cut_ranges(ranges, "start_ip", "end_ip", BLOCK_BITS)


def _measure(pieces: DataFrame) -> tuple[int, int]:
    """Bytes of the pieces and the most pieces in a block; refuses ranges that are not usable.

    The window sees one /16 block at a time, and clean ranges give a block 65,536 pieces at most.
    """
    in_order = Window.partitionBy("_block").orderBy("_first", "_last")
    overlap = F.lag("_last").over(in_order) >= F.col("_first")
    blocks = pieces.withColumn("_overlap", overlap).groupBy("_block").agg(
        F.count(F.lit(1)).alias("pieces"),
        F.sum(row_bytes(pieces)).alias("bytes"),
        F.count_if("_overlap").alias("overlaps"),
    )
    no_block = F.col("_block").isNull()
    found = blocks.agg(
        F.sum("bytes").alias("bytes"),
        F.max("pieces").alias("widest"),
        F.sum("overlaps").alias("overlaps"),
        F.sum(F.when(no_block, F.col("pieces"))).alias("unusable"),
    ).first()
    if found["unusable"]:
        raise ValueError(f"{found['unusable']} IP ranges lack a bound or end before they start")
    if found["overlaps"]:
        raise ValueError(f"{found['overlaps']} IP ranges overlap; an address must have one place (see flat_ranges)")
    return found["bytes"] or 0, found["widest"] or 0


def _as_of(ips: DataFrame, ip: str, pieces: DataFrame) -> DataFrame:
    """The last range that starts at or before each distinct address, if it reaches that far.

    Sorting inside /16 blocks avoids pairs of the two: a block holds at most 65,536 distinct
    addresses and as many pieces. Text that is no address is spread over blocks of its own.
    """
    number = ip_number(F.col(ip))
    no_address = -1 - F.pmod(F.xxhash64(ip), F.lit(1 << BLOCK_BITS))  # a block without ranges
    block = F.coalesce(_block(number), no_address)
    probes = ips.select(ip, "hits", number.alias("_at"), block.alias("_block"))
    starts = pieces.select(
        "_block", F.col("_first").alias("_at"), F.struct("_last", *PLACE_COLUMNS).alias("_range")
    )
    together = probes.unionByName(starts, allowMissingColumns=True)
    so_far = (
        Window.partitionBy("_block")
        .orderBy("_at", F.col("_range").isNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    latest = together.withColumn("_range", F.last("_range", ignorenulls=True).over(so_far))
    reached = F.col("_at") <= F.col("_range._last")
    return latest.where(F.col(ip).isNotNull()).select(
        ip, "hits", *[F.when(reached, F.col(f"_range.{c}")).alias(c) for c in PLACE_COLUMNS]
    )


def _two_levels(pieces: DataFrame, widest_block: int) -> tuple[DataFrame, DataFrame]:
    """Pieces of sparse /16 blocks, and those of dense ones cut at /24: twice as many at most.

    The dense blocks are a list of 65,536 numbers at most, so it is broadcast.
    """
    dense = pieces.groupBy("_block").count().where(F.col("count") > widest_block).select("_block")
    sparse = pieces.join(F.broadcast(dense), "_block", "left_anti")
    fine = cut_ranges(pieces.join(F.broadcast(dense), "_block", "left_semi"), "_first", "_last", FINE_BITS)
    return sparse, fine


def _looked_up(rows: DataFrame, pieces: DataFrame, bits: int, name: str) -> DataFrame:
    """Left equi-join on the block of ``_number``; the place goes to the struct ``name``."""
    found = pieces.select("_block", "_first", "_last", F.struct(*PLACE_COLUMNS).alias(name))
    inside = (_block(F.col("_number"), bits) == F.col("_block")) & F.col("_number").between(
        F.col("_first"), F.col("_last")
    )
    return rows.join(found, inside, "left").drop("_block", "_first", "_last")


def with_places(
    rows: DataFrame,
    ranges: DataFrame,
    ip: str = "ip",
    broadcast_bytes: int = BROADCAST_BYTES,
    widest_block: int = WIDEST_BLOCK,
    staged: bool = False,
) -> DataFrame:
    """Add country and province; null for addresses outside every range.

    ``ranges`` is ``(start_ip, end_ip, country, province)`` with inclusive bounds and no overlap.
    It is measured first. Blocks with more than ``widest_block`` pieces are cut at /24, and a hit is joined
    to its /16 block and, if there are dense ones, to its /24 block, so it looks through few pieces however
    dense the table is. A table of at most ``broadcast_bytes`` is broadcast and the hits are not shuffled.
    A larger one is searched once for each distinct address, then joined back, from rows written
    first if ``staged``; a stream, which cannot be read twice, takes the same joins by shuffle.
    """
    pieces = range_pieces(ranges)
    size, widest = _measure(pieces)
    dense = widest > widest_block
    small = (2 if dense else 1) * size <= broadcast_bytes
    if not small and not rows.isStreaming:
        return by_distinct_key(
            rows, ip, lambda ips: _as_of(ips, ip, pieces), broadcast_bytes, staged
        )
    hint = F.broadcast if small else lambda df: df.hint("merge")
    numbered = rows.withColumn("_number", ip_number(F.col(ip)))
    sparse, fine = _two_levels(pieces, widest_block) if dense else (pieces, None)
    joined = _looked_up(numbered, hint(sparse), BLOCK_BITS, "_coarse")
    place = F.col("_coarse")
    if fine is not None:
        joined = _looked_up(joined, hint(fine), FINE_BITS, "_fine")
        place = F.coalesce("_coarse", "_fine")
    return joined.select(*rows.columns, *[place[c].alias(c) for c in PLACE_COLUMNS])
