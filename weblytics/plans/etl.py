"""From log lines to the day table, as one logical plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weblytics.operators.agents import with_agents
from weblytics.operators.parse import parse_lines, with_format_time
from weblytics.operators.places import with_places
from weblytics.operators.upsert import in_key_ranges, latest_hits
from weblytics.schema import STORED_ROW, WEB_LOG_COLUMNS
from weblytics.sinks.day_table import replace_day
from weblytics.sources.logs import read_log_day


def web_logs(lines: DataFrame) -> DataFrame:
    """The twelve columns of the parsed record."""
    return with_agents(parse_lines(lines)).select(*WEB_LOG_COLUMNS)


def clean_lines(lines: DataFrame) -> DataFrame:
    """Parsed records with the formatted time."""
    return with_format_time(web_logs(lines))


def enriched(parsed: DataFrame, ranges: DataFrame | None, staged: bool = False) -> DataFrame:
    """Parsed hits with formatted time, agent columns and, if ranges are given, places."""
    hits = with_agents(with_format_time(parsed), staged=staged)
    return with_places(hits, ranges, staged=staged) if ranges is not None else hits


def all_hits(lines: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """Every hit, enriched, without a row key."""
    return enriched(parse_lines(lines), ranges)


def keyed_rows(
    lines: DataFrame, ranges: DataFrame | None = None, by_key: bool = False
) -> DataFrame:
    """Stored rows: one for each row key of ``(line, day)``.

    The upsert comes first, so only the surviving hits are enriched. ``by_key`` arranges them by
    row-key range for the bulk-load layout, before the enrichment, so that the sampling pass of
    the range exchange does not repeat it. A range table too large to broadcast moves the rows once
    more, by address, and the key ranges are lost; each written file is sorted all the same.
    """
    latest = latest_hits(lines).drop("line")
    rows = enriched(in_key_ranges(latest) if by_key else latest, ranges, staged=True)
    return rows.select(*[c for c in STORED_ROW.names if c in rows.columns])


def load_day(
    spark: SparkSession,
    log_root: str,
    day: str,
    table_root: str,
    ranges: DataFrame | None = None,
    by_key: bool = False,
) -> None:
    """The daily job: the files of ``<log_root>/<day>/`` replace that day of the table."""
    rows = keyed_rows(read_log_day(spark, log_root, day), ranges, by_key)
    replace_day(rows, table_root, day)
