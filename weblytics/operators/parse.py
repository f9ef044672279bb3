"""Access-log lines to records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblytics.functions.clock import format_time, log_instant, minute_text
from weblytics.functions.text import (
    MATCH_MARK,
    PART_MARK,
    PART_NAMES,
    UNKNOWN,
    WHOLE_LINE_PATTERN,
    info_hash,
    joined_text,
    marked_parts,
    null_if_empty,
    request_parts,
    row_key,
)
from weblytics.schema import NARROW_LOG_COLUMNS, REQUEST_COLUMNS


GOOD, REJECTED = "good", "rejected"


def parse_lines(lines: DataFrame) -> DataFrame:
    """Parse ``line``; lines that do not match are dropped, other input columns are kept.

    Only a matching line splits in two at the match mark, so matching and dropping share one regex
    pass: a test of the parsed columns themselves would be pushed below and run the regex again.
    """
    one_line = lines.where(~F.contains("line", F.lit(MATCH_MARK)))
    split = F.posexplode(F.split(marked_parts(F.col("line")), MATCH_MARK, -1))
    matched = one_line.select("*", split.alias("_at", "_text")).where(F.col("_at") == 1)
    return _records(matched, lines.columns)


def _records(matched: DataFrame, kept: Sequence[str]) -> DataFrame:
    """The columns of the record from ``_text``, the marked groups of a line."""
    parts = matched.select(*kept, F.split("_text", PART_MARK, -1).alias("_parts"))
    part = {name: F.get("_parts", F.lit(i)) for i, name in enumerate(PART_NAMES)}
    named = parts.select(
        *kept,
        *[value.alias(name) for name, value in part.items() if name != "request"],
        request_parts(part["request"]).alias("_tokens"),
    )
    tokens = F.col("_tokens")
    complete = F.size(tokens) == len(REQUEST_COLUMNS)
    return named.select(
        *kept,
        null_if_empty(F.col("ip")).alias("ip"),
        "time",
        *[
            F.when(complete, F.get(tokens, F.lit(i))).otherwise(UNKNOWN).alias(name)
            for i, name in enumerate(REQUEST_COLUMNS)
        ],
        "status",
        "bytesent",
        "refer",
        "agent",
    )


def routed_lines(lines: DataFrame) -> DataFrame:
    """Every line with ``route``: a good one with its record, a rejected one with ``line`` alone, in one regex pass."""
    halves = F.when(~F.contains("line", F.lit(MATCH_MARK)), F.split(marked_parts(F.col("line")), MATCH_MARK, -1))
    split = lines.select("*", halves.alias("_halves"))  # named and used twice, so it is computed once
    good = F.coalesce(F.size("_halves") == 2, F.lit(False))
    text = F.when(good, F.get("_halves", F.lit(1)))
    routed = split.select(*lines.columns, F.when(good, GOOD).otherwise(REJECTED).alias("route"), text.alias("_text"))
    records = _records(routed, [*lines.columns, "route"])
    fields = [c for c in records.columns if c not in (*lines.columns, "route")]
    is_good = F.col("route") == GOOD
    others = [c for c in lines.columns if c != "line"]
    return records.select(
        *others, *[F.when(is_good, F.col(c)).alias(c) for c in fields], F.when(~is_good, F.col("line")).alias("line"), "route"
    )


def unparsed_lines(lines: DataFrame) -> DataFrame:
    """The lines that ``parse_lines`` drops."""
    return lines.where(~F.coalesce(F.col("line").rlike(WHOLE_LINE_PATTERN), F.lit(False)))


def narrow_logs(enriched: DataFrame) -> DataFrame:
    return enriched.select(*NARROW_LOG_COLUMNS)


def with_event_time(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("event_ts", log_instant(F.col("time")))


def with_format_time(parsed: DataFrame) -> DataFrame:
    if "event_ts" in parsed.columns:
        return parsed.withColumn("formattime", minute_text(F.unix_seconds("event_ts")))
    return parsed.withColumn("formattime", format_time(F.col("time")))


def hit_hash() -> Column:
    """Hash of referer, url and ip, the variable part of the row key."""
    return info_hash(joined_text(F.col("refer"), F.col("url"), F.col("ip")))


def with_row_key(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("rowkey", row_key(F.col("day"), hit_hash()))
