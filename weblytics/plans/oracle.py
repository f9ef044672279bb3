"""The same queries as SQL text over the test tables, for a check by another engine."""

from __future__ import annotations

from weblytics.functions.agents import BROWSERS, SYSTEMS
from weblytics.functions.text import LINE_PATTERN, UNKNOWN
from weblytics.operators.orders import GRAINS, PAID_EVENT, PAID_STATUS, PLACED_EVENTS
from weblytics.plans.fixtures import AGENTS, SHIPPED_PRIORITY
from weblytics.plans.queries import BATCH_DAY, KEY_LIST_IP, NEXT_DAY, OPEN_FOR, SLIDING_SECONDS, WINDOW_SECONDS
from weblytics.sinks.routes import FIELDS as ROUTE_FIELDS
from weblytics.schema import (
    AGENT_COLUMNS,
    NARROW_LOG_COLUMNS,
    PLACE_COLUMNS,
    STORED_COLUMNS,
    WEB_LOG_COLUMNS,
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _names(*groups: tuple[str, ...], prefix: str = "") -> str:
    return ", ".join(f"{prefix}{name}" for group in groups for name in group)


_AGENT_CASE = " ".join(f"WHEN {i} THEN {_quoted(a)}" for i, a in enumerate(AGENTS))

_LINES = f"""
lines AS (
  SELECT strftime(ts, '%Y%m%d') AS day,
         CASE WHEN event_id % 17 = 0 THEN 'corrupt ' || event_id
         ELSE CASE WHEN event_id % 13 = 0 THEN ''
                   ELSE '10.' || (user_id % 32) || '.' || (event_id % 4) || '.1' END
              || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "'
              || CASE WHEN event_id % 11 = 0 THEN 'BAD'
                      ELSE CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END
                           || ' /p/' || (event_id % 7) || ' HTTP/1.1' END
              || '" ' || CASE WHEN event_type = 'error' THEN '500' ELSE '200' END
              || ' ' || CASE WHEN event_id % 5 = 0 THEN '-'
                             ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END
              || ' "' || CASE WHEN user_id % 2 = 0 THEN '-'
                              ELSE 'http://ref' || (user_id % 3) || '.example.org/' END
              || '" "' || CASE user_id % 5 {_AGENT_CASE} END || '"'
         END AS line
  FROM events
)"""

_PARSED = f"""
matched AS (
  SELECT day, line, regexp_extract(line, {_quoted(f"^{LINE_PATTERN}$")},
    ['ip', 'client', 'remote_user', 'time', 'request', 'status', 'bytesent', 'refer', 'agent']) AS g
  FROM lines WHERE regexp_full_match(line, {_quoted(LINE_PATTERN)})
),
tokens AS (SELECT *, string_split(rtrim(g.request, ' '), ' ') AS t FROM matched),
parsed AS (
  SELECT day, line, nullif(g.ip, '') AS ip, g.time AS time,
         CASE WHEN len(t) = 3 THEN t[1] ELSE '{UNKNOWN}' END AS method,
         CASE WHEN len(t) = 3 THEN t[2] ELSE '{UNKNOWN}' END AS url,
         CASE WHEN len(t) = 3 THEN t[3] ELSE '{UNKNOWN}' END AS protocal,
         g.status AS status, g.bytesent AS bytesent, g.refer AS refer, g.agent AS agent,
         strptime(g.time[2:21], '%d/%b/%Y:%H:%M:%S') AS event_ts
  FROM tokens
)"""


def _rule_rows(rules) -> str:
    return ", ".join(
        "(" + ", ".join([str(i), *[_quoted(field) for field in rule]]) + ")"
        for i, rule in enumerate(rules)
    )


_AGENT_INFO = f"""
agents AS (SELECT DISTINCT agent FROM parsed WHERE agent <> ''),
browser_rules(priority, token, name, mark) AS (VALUES {_rule_rows(BROWSERS)}),
system_rules(priority, token, family, name) AS (VALUES {_rule_rows(SYSTEMS)}),
browsers AS (
  SELECT agent, min_by(name, priority) AS name,
         min_by(CASE WHEN regexp_matches(agent[strpos(agent, mark) + len(mark):], '^[0-9.]')
                      AND contains(agent, mark)
                THEN regexp_extract(agent[strpos(agent, mark) + len(mark):], '^[0-9.]+')
                ELSE '{UNKNOWN}' END, priority) AS version
  FROM agents JOIN browser_rules ON contains(agent, token) GROUP BY agent
),
systems AS (
  SELECT agent, min_by(family, priority) AS family, min_by(name, priority) AS name
  FROM agents JOIN system_rules ON contains(agent, token) GROUP BY agent
),
agent_info AS (
  SELECT agent, coalesce(b.name, '{UNKNOWN}') AS browserName,
         coalesce(b.version, '{UNKNOWN}') AS browserVersion,
         coalesce(s.family, '{UNKNOWN}') AS osName, coalesce(s.name, '{UNKNOWN}') AS osVersion
  FROM agents LEFT JOIN browsers b USING (agent) LEFT JOIN systems s USING (agent)
)"""

_PLACES = """
ranges AS (
  SELECT (10 * 256 + n_nationkey) * 65536 AS start_ip,
         (10 * 256 + n_nationkey) * 65536 + 65535 AS end_ip,
         r_name AS country, n_name AS province
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
ips AS (
  SELECT ip, (o[1] * 16777216 + o[2] * 65536 + o[3] * 256 + o[4]) AS number
  FROM (SELECT ip, CAST(string_split(ip, '.') AS BIGINT[]) AS o
        FROM (SELECT DISTINCT ip FROM parsed WHERE ip IS NOT NULL))
),
ip_places AS (
  SELECT ip, country, province FROM ips LEFT JOIN ranges ON number BETWEEN start_ip AND end_ip
)"""

# CRC-32 over the character codes (the rendered lines are ASCII); polynomial 3988292384.
_KEYS = """
crc_steps AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM range(256) AS r(i)
),
infos AS (
  SELECT DISTINCT coalesce(refer, 'null') || coalesce(url, 'null') || coalesce(ip, 'null') AS info
  FROM parsed
),
hashes AS (
  SELECT info, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT,
             list_transform(string_split(info, ''), lambda ch: ascii(ch)::BIGINT)),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS hash
  FROM infos, crc_steps
),
keyed AS (
  SELECT p.*, day || '_' || hash AS rowkey
  FROM parsed p JOIN hashes
    ON info = coalesce(refer, 'null') || coalesce(url, 'null') || coalesce(ip, 'null')
)"""

_STORED = f"""
winners AS (
  SELECT * FROM keyed
  QUALIFY row_number() OVER (PARTITION BY day, rowkey ORDER BY event_ts DESC, line DESC) = 1
),
stored AS (
  SELECT day, rowkey, {_names(STORED_COLUMNS, PLACE_COLUMNS)}
  FROM (SELECT w.*, strftime(event_ts, '%Y%m%d%H%M') AS formattime FROM winners w)
  LEFT JOIN agent_info USING (agent) LEFT JOIN ip_places USING (ip)
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_TO_PARSED = _with(_LINES, _PARSED)
_TO_AGENTS = _with(_LINES, _PARSED, _AGENT_INFO)
_TO_STORED = _with(_LINES, _PARSED, _AGENT_INFO, _PLACES, _KEYS, _STORED)

_JOB = _with(
    _LINES.replace("lines AS", "all_lines AS", 1),
    f"""
lines AS (
  SELECT CASE WHEN contains(line, 'POST') THEN '{NEXT_DAY}' ELSE '{BATCH_DAY}' END AS day, line FROM all_lines
)""",
    _PARSED, _AGENT_INFO, _PLACES, _KEYS, _STORED,
)

_MIXED_PLACES = _PLACES.replace(_PLACES[: _PLACES.index("ips AS")], """
ranges AS (
  SELECT start_ip, start_ip + CASE WHEN k < 10 THEN 65536 WHEN k < 15 THEN 128 WHEN k = 15 THEN 262144 ELSE 256 END - 1
         AS end_ip, country, province
  FROM (SELECT n_nationkey AS k, (10 * 256 + n_nationkey) * 65536 + i * 192 AS start_ip, r_name AS country,
               n_name || ' ' || i AS province
        FROM nation JOIN region ON n_regionkey = r_regionkey, range(300) AS p(i)
        WHERE n_nationkey NOT BETWEEN 16 AND 19 AND (i = 0 OR n_nationkey BETWEEN 10 AND 14))
),
""")

_NESTED_PLACES = _PLACES.replace("ranges AS", "blocks AS", 1).replace(_PLACES[_PLACES.index("ip_places AS"):], """
ranges AS (
  SELECT * FROM blocks
  UNION ALL SELECT start_ip + a, start_ip + b, country, province || name
  FROM blocks, (VALUES (256, 511, ' inner'), (384, 767, ' across'), (769, 769, ' host')) AS p(a, b, name)
  UNION ALL SELECT min(start_ip), max(end_ip), country, 'all' FROM blocks GROUP BY country
),
ip_places AS (
  SELECT ip, country, province FROM ips LEFT JOIN ranges ON number BETWEEN start_ip AND end_ip
  QUALIFY row_number() OVER (
    PARTITION BY ip ORDER BY end_ip - start_ip, start_ip DESC, country DESC, province DESC) = 1
)""")

_UNITS = f"""
WITH agents AS (
  SELECT CASE WHEN event_id % 19 <> 0 THEN base || ' Unit/' || (event_id % 5000) || '.' || (user_id % 7) ELSE base END AS agent
  FROM (SELECT *, CASE user_id % 5 {_AGENT_CASE} END AS base FROM events)
),
rules AS (
  SELECT 'browser' AS kind, p_partkey AS priority, 'Unit/' || p_partkey || '.' AS token, 'Unit ' || p_partkey AS name,
         '/' || p_partkey || '.' AS detail FROM part
  UNION ALL SELECT 'system', -p_partkey, p_partkey || '.', 'Unit', 'Unit system ' || p_partkey FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT 'browser', {SHIPPED_PRIORITY} + priority, token, name, mark FROM (VALUES {_rule_rows(BROWSERS)}) AS b(priority, token, name, mark)
  UNION ALL SELECT 'system', {SHIPPED_PRIORITY} + priority, token, family, name FROM (VALUES {_rule_rows(SYSTEMS)}) AS s(priority, token, family, name)
),
chosen AS (
  SELECT agent, min_by({{'n': name, 'd': detail}}, priority) FILTER (kind = 'browser') AS b,
         min_by({{'n': name, 'd': detail}}, priority) FILTER (kind = 'system') AS s
  FROM (SELECT DISTINCT agent FROM agents) JOIN rules ON contains(agent, token) GROUP BY agent
)
SELECT agent,
  CASE WHEN agent <> '' THEN coalesce(b.n, '{UNKNOWN}') END AS browserName,
  CASE WHEN agent <> '' THEN coalesce(CASE WHEN contains(agent, b.d)
    THEN nullif(regexp_extract(agent[strpos(agent, b.d) + len(b.d):], '^[0-9.]+'), '') END, '{UNKNOWN}') END AS browserVersion,
  CASE WHEN agent <> '' THEN coalesce(s.n, '{UNKNOWN}') END AS osName,
  CASE WHEN agent <> '' THEN coalesce(s.d, '{UNKNOWN}') END AS osVersion
FROM agents LEFT JOIN chosen USING (agent)"""

_CELLS = """
SELECT rowkey, 'O' AS family, qualifier, value
FROM (UNPIVOT {rows} ON {columns} INTO NAME qualifier VALUE value)"""


def _cells(rows: str) -> str:
    return _CELLS.format(rows=rows, columns=_names(STORED_COLUMNS, PLACE_COLUMNS))


_PLACED = ", ".join(_quoted(e) for e in PLACED_EVENTS)
_CENTS = "sum(CAST(round_even({amount} * 100, 0) AS BIGINT))"
_EVENT_CENTS = _CENTS.format(amount="value")


def _bucket(grain: str, ts: str = "ts") -> str:
    return f"strftime(date_trunc('{grain}', {ts}), '%Y-%m-%d %H:%M:%S')"


def _totals(grain: str) -> str:
    return f"""
SELECT {_bucket(grain)} AS bucket, count(*) AS paid_orders,
       CAST({_EVENT_CENTS} AS DOUBLE) / 100 AS paid_amount
FROM events WHERE event_type = '{PAID_EVENT}' GROUP BY 1"""


def _share(grain: str) -> str:
    return f"""
SELECT bucket, paid_orders, placed_orders, paid_orders::DOUBLE / placed_orders AS paid_share
FROM (SELECT {_bucket(grain)} AS bucket, count(*) FILTER (event_type = '{PAID_EVENT}') AS paid_orders,
             count(*) AS placed_orders
      FROM events WHERE event_type IN ({_PLACED}) GROUP BY 1)"""


def _windows(size: int, slide: int) -> str:
    at = "strftime(make_timestamp({seconds} * 1000000), '%Y-%m-%d %H:%M:%S')"
    return f"""
WITH paid AS (
  SELECT value, CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS s
  FROM events WHERE event_type = '{PAID_EVENT}'
),
placed AS (
  SELECT value, (s // {slide}) * {slide} - back AS start
  FROM paid, range(0, {size}, {slide}) AS b(back)
)
SELECT {at.format(seconds="start")} AS window_start,
       {at.format(seconds=f"(start + {size})")} AS window_end,
       count(*) AS paid_orders, CAST({_EVENT_CENTS} AS DOUBLE) / 100 AS paid_amount
FROM placed GROUP BY start"""


_LATE = f"""
WITH newest AS (SELECT max(ts) AS top FROM events WHERE event_type IN ({_PLACED})),
kept AS (
  SELECT * FROM events, newest
  WHERE ts > top - INTERVAL 24 HOURS OR date_trunc('hour', ts) + INTERVAL 1 HOUR > top - INTERVAL 1 HOUR
)
SELECT {_bucket('hour')} AS bucket, count(*) AS paid_orders, CAST({_EVENT_CENTS} AS DOUBLE) / 100 AS paid_amount
FROM kept WHERE event_type = '{PAID_EVENT}' GROUP BY 1"""


def all_oracles() -> dict[str, str]:
    web_log = f"SELECT {_names(WEB_LOG_COLUMNS)} FROM parsed LEFT JOIN agent_info USING (agent)"
    agents = f"SELECT agent, {_names(AGENT_COLUMNS)} FROM parsed LEFT JOIN agent_info USING (agent)"
    places = f"SELECT ip, {_names(PLACE_COLUMNS)} FROM parsed LEFT JOIN ip_places USING (ip)"
    stored = f"SELECT day, rowkey, {_names(STORED_COLUMNS, PLACE_COLUMNS)} FROM stored"
    by_place = "SELECT country, province, count(*) AS {name} FROM stored GROUP BY ALL"
    by_browser = "SELECT browserName AS browsername, count(*) AS {name} FROM stored GROUP BY ALL"
    orders_daily = f"""
SELECT {_bucket("day", "o_orderdate")} AS bucket, count(*) AS paid_orders,
       CAST({_CENTS.format(amount="o_totalprice")} AS DOUBLE) / 100 AS paid_amount
FROM orders WHERE o_orderstatus = '{PAID_STATUS}' GROUP BY 1"""
    named = {
        "parse_logs": f"{_TO_AGENTS} {web_log}",
        "stream_parse_logs": f"{_TO_AGENTS} SELECT {_names(WEB_LOG_COLUMNS)}, "
        "strftime(event_ts, '%Y%m%d%H%M') AS formattime FROM parsed LEFT JOIN agent_info USING (agent)",
        "narrow_logs": f"{_TO_AGENTS} SELECT {_names(NARROW_LOG_COLUMNS)} "
        "FROM parsed LEFT JOIN agent_info USING (agent)",
        "unparsed_lines": f"{_with(_LINES)} SELECT count(*) AS unparsed FROM lines "
        f"WHERE NOT regexp_full_match(line, {_quoted(LINE_PATTERN)})",
        "format_time": f"{_TO_PARSED} SELECT time, strftime(event_ts, '%Y%m%d%H%M') AS formattime "
        "FROM parsed",
        "agent_enriched": f"{_TO_AGENTS} {agents}",
        "agent_enriched_distinct": f"{_TO_AGENTS} {agents}",
        "geo_enriched": f"{_with(_LINES, _PARSED, _PLACES)} {places}",
        "geo_enriched_distinct": f"{_with(_LINES, _PARSED, _PLACES)} {places}",
        "geo_mixed_widths": f"{_with(_LINES, _PARSED, _MIXED_PLACES)} {places}",
        "geo_nested_ranges": f"{_with(_LINES, _PARSED, _NESTED_PLACES)} {places}",
        "agent_rules_table": _UNITS,
        "routed_lines": f"{_TO_PARSED} SELECT {_names(ROUTE_FIELDS)}, NULL AS line, 'good' AS route FROM parsed UNION ALL SELECT "
        + ", ".join(f"NULL AS {c}" for c in ROUTE_FIELDS)
        + f", line, 'rejected' FROM lines WHERE NOT regexp_full_match(line, {_quoted(LINE_PATTERN)})",
        "rows_by_key": f"{_TO_STORED} {stored} WHERE rowkey IN (SELECT rowkey FROM keyed WHERE ip LIKE '{KEY_LIST_IP}%')",
        "visit_rankings": f"""{_TO_STORED} SELECT CASE WHEN grouping(browserName) = 1 THEN 'place' ELSE 'browser' END AS ranking,
          country, province, browserName AS browsername, count(*) AS cnt
          FROM stored GROUP BY GROUPING SETS ((country, province), (browserName))""",
        "read_daylog": f"{_with(_LINES)} SELECT line, day FROM lines",
        "stream_open_windows": f"""WITH newest AS (SELECT max(ts) AS top FROM events WHERE event_type = '{PAID_EVENT}')
          SELECT {_bucket('hour')} AS bucket, count(*) AS paid_orders, CAST({_EVENT_CENTS} AS DOUBLE) / 100 AS paid_amount
          FROM events, newest WHERE event_type = '{PAID_EVENT}'
            AND date_trunc('hour', ts) + INTERVAL 1 HOUR > top - INTERVAL {OPEN_FOR} GROUP BY 1""",
        "stream_keyed_rows": f"{_TO_STORED} {stored}",
        "stream_paid_window_panes": _windows(*SLIDING_SECONDS),
        "daily_job": f"{_JOB} SELECT day, country, province, browserName, count(*) AS cnt "
        "FROM stored GROUP BY ALL",
        "row_keys": f"{_with(_LINES, _PARSED, _KEYS)} SELECT day, refer, url, ip, rowkey FROM keyed",
        "keyed_rows": f"{_TO_STORED} {stored}",
        "day_table_roundtrip": f"{_TO_STORED} {stored}",
        "row_cells": f"{_TO_STORED} {_cells('stored')}",
        "sample_rows": f"{_TO_STORED} {_cells('(SELECT * FROM stored ORDER BY rowkey LIMIT 10)')}",
        "preview_rows": f"{_TO_STORED} {stored} ORDER BY rowkey LIMIT 20",
        "visits_by_place_top10": f"{_TO_STORED} {by_place.format(name='cnt')} "
        "ORDER BY cnt DESC, country NULLS FIRST, province NULLS FIRST LIMIT 10",
        "visits_by_place_df": f"{_TO_STORED} {by_place.format(name='count')}",
        "visits_by_place_sql": f"{_TO_STORED} {by_place.format(name='cnt')}",
        "visits_by_browser": f"{_TO_STORED} {by_browser.format(name='cnt')}",
        "visits_by_browser_df": f"{_TO_STORED} {by_browser.format(name='count')}",
        "visits_all_hits": f"{_TO_AGENTS} SELECT browserName AS browsername, count(*) AS cnt "
        "FROM parsed LEFT JOIN agent_info USING (agent) GROUP BY ALL",
        "browser_stat_sink": f"{_TO_STORED} SELECT day, browserName AS browsername, "
        "CAST(count(*) AS INTEGER) AS cnt FROM stored GROUP BY ALL",
        "paid_orders_daily": orders_daily,
        "stream_upsert": _share("hour"),
        "stream_late_orders": _LATE,
    }
    for prefix in ("paid", "stream_paid"):
        named[f"{prefix}_window_tumbling"] = _windows(WINDOW_SECONDS, WINDOW_SECONDS)
        named[f"{prefix}_window_sliding"] = _windows(*SLIDING_SECONDS)
        for grain in GRAINS:
            named[f"{prefix}_by_{grain}"] = _totals(grain)
            named[f"{prefix}_ratio_{grain}"] = _share(grain)
    return named
