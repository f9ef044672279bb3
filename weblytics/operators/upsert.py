"""One stored row for each row key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblytics.functions.text import row_key
from weblytics.operators.parse import hit_hash, parse_lines, with_event_time


def latest_hits(lines: DataFrame) -> DataFrame:
    """Parsed ``(line, day)`` with ``event_ts`` and ``rowkey``: the latest hit for each row key.

    Ties go to the greatest line. An aggregate rather than a ranking window: the partial ``max``
    reduces a hot key inside each map task before the one shuffle. The parsed columns travel
    along, which costs far less than a second parse of the winners. The number in the row key is
    grouped on in its place, because it is shorter and sorts faster.
    """
    hits = with_event_time(parse_lines(lines))
    carried = [c for c in hits.columns if c not in ("day", "line", "event_ts")]
    winner = F.max(F.struct("event_ts", "line", *carried)).alias("_winner")
    latest = hits.groupBy(hit_hash().alias("_hash"), "day").agg(winner)
    return latest.select(
        "day", row_key(F.col("day"), F.col("_hash")).alias("rowkey"), "_winner.*"
    )


def in_key_ranges(keyed: DataFrame) -> DataFrame:
    """Rows with neighbouring row keys in one partition, for files that cover a key range.

    The key starts with the day, so a partition holds one day, or the border of two.
    """
    return keyed.repartitionByRange("rowkey")
