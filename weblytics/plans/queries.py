"""The queries by name. Each takes ``(spark, sf_dir)`` and reads its tables whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblytics.functions.clock import format_time
from weblytics.operators import orders as O
from weblytics.operators import visits as V
from weblytics.operators.agent_rules import with_agent_rules
from weblytics.operators.agents import with_agents
from weblytics.operators.cells import first_rows, sorted_cells, to_cells
from weblytics.operators.nested_places import flat_ranges
from weblytics.operators.parse import GOOD, REJECTED, narrow_logs, parse_lines, unparsed_lines, with_row_key
from weblytics.operators.places import with_places
from weblytics.plans import etl
from weblytics.plans.fixtures import (
    events,
    ip_ranges,
    log_lines,
    mixed_ranges,
    nested_ranges,
    numbered_agents,
    unit_rules,
)
from weblytics.schema import FORMATTED_LOG
from weblytics.session import scratch_dir
from weblytics.sinks.day_table import replace_days
from weblytics.sinks.key_ranges import replace_keyed_days, rows_of_keys
from weblytics.sinks.results import read_browser_stat, replace_browser_stat
from weblytics.sinks.routes import read_route, write_routes
from weblytics.sources.day_table import reused, scan_day, scan_days
from weblytics.sources.daylog import register_daylog
from weblytics.sources.logs import read_log_day, stream_lines, stream_log_days
from weblytics.sources.orders import stream_events
from weblytics.streaming.keyed import live_keyed_rows
from weblytics.streaming.logs import start_clean
from weblytics.streaming.orders import live_orders, start_append, start_upsert
from weblytics.streaming.state import open_totals, state_on_disk
from weblytics.streaming.upsert import fold_upserted, read_upserted

Query = Callable[[SparkSession, str], DataFrame]

NEXT_DAY = "20240201"
EARLY_DAYS = ("20240114", "20240115")  # the last days of a first load that reach into the second one
KEY_LIST_IP, KEY_RANGES = "10.7.", 8
BATCH_DAY = "20240131"  # folder of the rendered log: the batch day, not the day of a line
WINDOW_SECONDS = 900
OPEN_FOR = "6 hours"
SLIDING_SECONDS = (3600, 900)


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.keyed_rows(log_lines(spark, sf_dir), ip_ranges(spark, sf_dir))


def _keyed_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.keyed_rows(log_lines(spark, sf_dir))


def _written_log(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_dir(spark, "log")
    log_lines(spark, sf_dir).select("line").write.text(f"{root}/{BATCH_DAY}")
    return root


# Log clean-up

def parse_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _written_log(spark, sf_dir)
    return etl.web_logs(read_log_day(spark, root, BATCH_DAY))


def read_daylog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of all days through the data source of its own."""
    root = scratch_dir(spark, "log")
    log_lines(spark, sf_dir).write.partitionBy("day").text(root)
    register_daylog(spark)
    return spark.read.format("daylog").load(root)


def narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return narrow_logs(etl.web_logs(log_lines(spark, sf_dir)))


def unparsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unparsed_lines(log_lines(spark, sf_dir)).agg(F.count(F.lit(1)).alias("unparsed"))


def format_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lines(log_lines(spark, sf_dir))
    return parsed.select("time", format_time(F.col("time")).alias("formattime"))


def agent_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lines(log_lines(spark, sf_dir)).select("agent")
    return with_agents(parsed)


def agent_enriched_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lines(log_lines(spark, sf_dir)).select("agent")
    return with_agents(parsed, distinct_first=True)


def geo_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lines(log_lines(spark, sf_dir)).select("ip")
    return with_places(parsed, ip_ranges(spark, sf_dir))


def geo_enriched_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route for range tables too large to broadcast."""
    parsed = parse_lines(log_lines(spark, sf_dir)).select("ip")
    return with_places(parsed, ip_ranges(spark, sf_dir), broadcast_bytes=0)


def geo_mixed_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges inside one block, of several blocks, and more in a block than a probe looks through."""
    parsed = parse_lines(log_lines(spark, sf_dir)).select("ip")
    return with_places(parsed, mixed_ranges(spark, sf_dir))


def geo_nested_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges inside ranges and across each other: the narrowest wins."""
    parsed = parse_lines(log_lines(spark, sf_dir)).select("ip")
    return with_places(parsed, flat_ranges(nested_ranges(spark, sf_dir)))


def agent_rules_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agents by a table of rules that grows with the parts."""
    return with_agent_rules(numbered_agents(spark, sf_dir), unit_rules(spark, sf_dir))


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good records and rejected lines, written by one job and read back."""
    path = scratch_dir(spark, "routes")
    write_routes(log_lines(spark, sf_dir).select("line"), path)
    good, rejected = (read_route(spark, path, r).withColumn("route", F.lit(r)) for r in (GOOD, REJECTED))
    return good.unionByName(rejected, allowMissingColumns=True)


# Keys, stored rows, cells

def row_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = with_row_key(parse_lines(log_lines(spark, sf_dir)))
    return keyed.select("day", "refer", "url", "ip", "rowkey")


def row_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_cells(_keyed(spark, sf_dir))


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the first 10 stored rows."""
    return to_cells(first_rows(_keyed(spark, sf_dir), 10))


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 20 stored rows."""
    return first_rows(_keyed(spark, sf_dir), 20)


def day_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "days")
    rows = etl.keyed_rows(log_lines(spark, sf_dir), ip_ranges(spark, sf_dir), by_key=True)
    replace_days(rows, root)
    return scan_days(spark, root)


def daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines over two days, the first day loaded with changed lines and then again; visits of each from three columns."""
    logs, table = scratch_dir(spark, "log"), scratch_dir(spark, "days")
    lines, ranges = log_lines(spark, sf_dir).select("line"), ip_ranges(spark, sf_dir)
    posted = F.contains("line", F.lit("POST"))
    changed = F.regexp_replace(F.regexp_replace("line", "^10[.]", "11."), '" (200|500) ', '" 404 ')
    first, second = lines.where(~posted), lines.where(posted)
    loads = ((BATCH_DAY, first.select(changed.alias("line")), "a"), (NEXT_DAY, second, "a"), (BATCH_DAY, first, "b"))
    for day, some, root in loads:
        some.write.text(f"{logs}/{root}/{day}")
        etl.load_day(spark, f"{logs}/{root}", day, table, ranges, by_key=True)
    days = [
        scan_day(spark, table, day, ["country", "province", "browserName"]).select(F.lit(day).alias("day"), "*")
        for day in (BATCH_DAY, NEXT_DAY)
    ]
    visits = days[0].unionByName(days[1])
    return visits.groupBy("day", "country", "province", "browserName").agg(F.count(F.lit(1)).alias("cnt"))


def rows_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows of a key list, from a table loaded in two parts whose days overlap."""
    root = scratch_dir(spark, "key-ranges")
    rows = etl.keyed_rows(log_lines(spark, sf_dir), ip_ranges(spark, sf_dir))
    replace_keyed_days(rows.where(F.col("day") <= EARLY_DAYS[1]), root, KEY_RANGES)
    replace_keyed_days(rows.where(F.col("day") >= EARLY_DAYS[0]), root)
    keyed = with_row_key(parse_lines(log_lines(spark, sf_dir)))
    return rows_of_keys(spark, root, keyed.where(F.col("ip").startswith(KEY_LIST_IP)).select("rowkey"))


# Visits

def visits_by_place_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.top_places(_keyed(spark, sf_dir))


def visits_by_place_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.visits_by_place_df(_keyed(spark, sf_dir))


def visits_by_place_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.visits_by_place_sql(_keyed(spark, sf_dir))


def visits_by_browser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.ranked(V.visits_by_browser(_keyed_agents(spark, sf_dir)))


def visits_by_browser_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.visits_by_browser_df(_keyed_agents(spark, sf_dir))


def visits_all_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.ranked(V.visits_by_browser(etl.all_hits(log_lines(spark, sf_dir))))


def browser_stat_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result table from the day table, written twice: the rerun replaces its days."""
    root, result = scratch_dir(spark, "days"), scratch_dir(spark, "browser-stat")
    replace_days(etl.keyed_rows(log_lines(spark, sf_dir), by_key=True), root)
    with reused(V.browser_stat(scan_days(spark, root, ["day", "browserName"]))) as counts:
        replace_browser_stat(counts, result)
        replace_browser_stat(counts, result)
    return read_browser_stat(spark, result)


def visit_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.visit_rankings(_keyed(spark, sf_dir))


# Orders

def _batch_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.orders_of_events(events(spark, sf_dir))


def _totals(grain: str) -> Query:
    return lambda spark, sf_dir: O.paid_totals(_batch_orders(spark, sf_dir), grain)


def _share(grain: str) -> Query:
    return lambda spark, sf_dir: O.paid_share(_batch_orders(spark, sf_dir), grain)


def paid_orders_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return O.paid_totals(O.orders_of_table(table), "day")


def paid_window_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.paid_windows(_batch_orders(spark, sf_dir), WINDOW_SECONDS)


def paid_window_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.paid_windows(_batch_orders(spark, sf_dir), *SLIDING_SECONDS)


# Streams

def _streamed(summary: Callable[[DataFrame], DataFrame], *keys: str) -> Query:
    """Run the summary over the events as a stream to its end and return its newest results.

    The table is history whose files come in any order, so no window is closed early.
    """
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = stream_events(spark, f"{sf_dir}/events.parquet")
        results = summary(live_orders(source, lateness=None))
        path = scratch_dir(spark, "stream")
        start_upsert(results, path, scratch_dir(spark, "checkpoint")).awaitTermination()
        return read_upserted(spark, path, results.schema, keys)

    return query


def _stream_totals(grain: str) -> Query:
    return _streamed(lambda orders: O.paid_totals(orders, grain), "bucket")


def _stream_share(grain: str) -> Query:
    return _streamed(lambda orders: O.paid_share(orders, grain), "bucket")


def _stream_windows(*seconds: int) -> Query:
    return _streamed(lambda orders: O.paid_windows(orders, *seconds), "window_start", "window_end")


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paid share by hour from four parts that all reach every window, one a run, folded half-way."""
    folder, checkpoint = scratch_dir(spark, "event-files"), scratch_dir(spark, "checkpoint")
    paths = scratch_dir(spark, "stream"), scratch_dir(spark, "stream")
    for part in range(4):
        events(spark, sf_dir).where(F.pmod("event_id", F.lit(4)) == part).write.mode("append").parquet(folder)
        results = O.paid_share(live_orders(stream_events(spark, folder), lateness=None), "hour")
        start_upsert(results, paths[part // 2], checkpoint).awaitTermination()
        if part == 1:
            fold_upserted(spark, *paths, results.schema, ["bucket"])
    return read_upserted(spark, paths[-1], results.schema, ["bucket"])


def stream_late_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paid orders by hour under a watermark: events of the last day come first, then all the others.

    The second part is read after the watermark has passed its hours, so what is an hour or more older than the
    newest event is dropped.
    """
    folder, checkpoint, path = (scratch_dir(spark, p) for p in ("event-files", "checkpoint", "stream"))
    newest = F.lit(events(spark, sf_dir).where(F.col("event_type").isin(*O.PLACED_EVENTS)).agg(F.max("ts")).first()[0])
    recent = F.col("ts") > newest.cast("timestamp_ntz") - F.expr("interval 24 hours")
    for chosen in (recent, ~recent):
        events(spark, sf_dir).where(chosen).write.mode("append").parquet(folder)
        results = O.paid_totals(live_orders(stream_events(spark, folder)), "hour")
        start_upsert(results, path, checkpoint).awaitTermination()
    return read_upserted(spark, path, results.schema, ["bucket"])


def stream_paid_window_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows from panes, each written once when closed. An order long after all others closes them; its own stay open."""
    last = scratch_dir(spark, "event-files")
    after = F.max("ts") + F.expr("interval 3 days")
    events(spark, sf_dir).agg(after.alias("ts"), F.lit(O.PAID_EVENT).alias("event_type")).write.parquet(last)
    source = stream_events(spark, f"{sf_dir}/events.parquet").unionByName(stream_events(spark, last))
    results = O.live_windows_of_panes(live_orders(source), *SLIDING_SECONDS)
    path = scratch_dir(spark, "stream")
    start_append(results, path, scratch_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(results.schema).parquet(path)


def stream_keyed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert on a stream: days up to the middle with the newest lines held back, then these, a replay and the rest."""
    folder, checkpoint, path = (scratch_dir(spark, p) for p in ("log", "checkpoint", "stream"))
    lines = log_lines(spark, sf_dir)
    early, fresh = F.col("day") <= EARLY_DAYS[1], F.col("day") >= EARLY_DAYS[0]
    held_back = fresh & (F.pmod(F.xxhash64("line"), F.lit(2)) == 0)
    for chosen in (early & ~held_back, fresh):
        lines.where(chosen).write.mode("append").partitionBy("day").text(folder)
        rows = live_keyed_rows(stream_log_days(spark, folder), ip_ranges(spark, sf_dir))
        start_upsert(rows, path, checkpoint).awaitTermination()
    return read_upserted(spark, path, rows.schema, ["day", "rowkey"])


def stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours that the state still holds after all events, read from a state store on disk."""
    checkpoint = scratch_dir(spark, "checkpoint")
    results = O.paid_totals(live_orders(stream_events(spark, f"{sf_dir}/events.parquet"), OPEN_FOR), "hour")
    with state_on_disk(spark):
        start_upsert(results, scratch_dir(spark, "stream"), checkpoint).awaitTermination()
    return open_totals(spark, checkpoint)


def stream_parse_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, path = _written_log(spark, sf_dir), scratch_dir(spark, "stream-log")
    lines = stream_lines(spark, f"{root}/{BATCH_DAY}")
    start_clean(lines, path, scratch_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(FORMATTED_LOG).parquet(path)


def all_queries() -> dict[str, Query]:
    named = {
        "parse_logs": parse_logs,
        "narrow_logs": narrow,
        "unparsed_lines": unparsed,
        "format_time": format_times,
        "agent_enriched": agent_enriched,
        "agent_enriched_distinct": agent_enriched_distinct,
        "geo_enriched": geo_enriched,
        "geo_enriched_distinct": geo_enriched_distinct,
        "geo_mixed_widths": geo_mixed_widths,
        "geo_nested_ranges": geo_nested_ranges,
        "agent_rules_table": agent_rules_table,
        "routed_lines": routed,
        "rows_by_key": rows_by_key,
        "visit_rankings": visit_rankings,
        "stream_paid_window_panes": stream_paid_window_panes,
        "read_daylog": read_daylog,
        "stream_open_windows": stream_open_windows,
        "stream_keyed_rows": stream_keyed_rows,
        "row_keys": row_keys,
        "keyed_rows": _keyed,
        "row_cells": row_cells,
        "sample_rows": sample_rows,
        "preview_rows": preview_rows,
        "day_table_roundtrip": day_table_roundtrip,
        "daily_job": daily_job,
        "visits_by_place_top10": visits_by_place_top10,
        "visits_by_place_df": visits_by_place_df,
        "visits_by_place_sql": visits_by_place_sql,
        "visits_by_browser": visits_by_browser,
        "visits_by_browser_df": visits_by_browser_df,
        "visits_all_hits": visits_all_hits,
        "browser_stat_sink": browser_stat_sink,
        "paid_orders_daily": paid_orders_daily,
        "paid_window_tumbling": paid_window_tumbling,
        "paid_window_sliding": paid_window_sliding,
        "stream_paid_window_tumbling": _stream_windows(WINDOW_SECONDS),
        "stream_paid_window_sliding": _stream_windows(*SLIDING_SECONDS),
        "stream_upsert": stream_upsert,
        "stream_late_orders": stream_late_orders,
        "stream_parse_logs": stream_parse_logs,
    }
    for grain in O.GRAINS:
        named[f"paid_by_{grain}"] = _totals(grain)
        named[f"paid_ratio_{grain}"] = _share(grain)
        named[f"stream_paid_by_{grain}"] = _stream_totals(grain)
        named[f"stream_paid_ratio_{grain}"] = _stream_share(grain)
    return named
