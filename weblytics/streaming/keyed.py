"""The upsert by row key on a stream: the latest hit of each key is state, and old days leave it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblytics.functions.text import row_key
from weblytics.operators.parse import hit_hash, parse_lines, with_event_time
from weblytics.plans.etl import enriched
from weblytics.schema import STORED_ROW

LATENESS = "2 days"
DAY_FORMAT = "yyyyMMdd"


def day_instant(day: Column) -> Column:
    """Midnight of a day folder; null if it is no day."""
    return F.try_to_timestamp(day, F.lit(DAY_FORMAT))


def live_latest_hits(lines: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """``latest_hits`` of a stream of ``(line, day)``, as an aggregate with state.

    Event time is the day of the folder, not the time in the line: a line with a clock of its own cannot close the
    days of others. A key leaves the state when its day has ended ``lateness`` before the newest day; lines
    for it that come later are dropped. Until then replayed lines change nothing and late ones compete like any other.
    Lines whose folder is no day are dropped.
    """
    hits = with_event_time(parse_lines(lines)).withColumn("_log_day", day_instant(F.col("day")))
    carried = [c for c in hits.columns if c not in ("day", "line", "event_ts", "_log_day")]
    winner = F.max(F.struct("event_ts", "line", *carried)).alias("_winner")
    open_days = F.window("_log_day", "1 day").alias("_open")
    latest = hits.withWatermark("_log_day", lateness).groupBy(open_days, hit_hash().alias("_hash"), "day").agg(winner)
    return latest.select("day", row_key(F.col("day"), F.col("_hash")).alias("rowkey"), "_winner.*")


def live_keyed_rows(lines: DataFrame, ranges: DataFrame | None = None, lateness: str = LATENESS) -> DataFrame:
    """Stored rows of a stream, in update mode: each row that a batch changed."""
    rows = enriched(live_latest_hits(lines, lateness).drop("line"), ranges)
    return rows.select(*[c for c in STORED_ROW.names if c in rows.columns])
