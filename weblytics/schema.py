"""Fixed schemas. Every read passes one of these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# --- Fixed values: column names of the log contract, spelling included ---
REQUEST_COLUMNS = ("method", "url", "protocal")
AGENT_COLUMNS = ("browserName", "browserVersion", "osName", "osVersion")
PLACE_COLUMNS = ("country", "province")
WEB_LOG_COLUMNS = ("ip", "time", *REQUEST_COLUMNS, "status", "bytesent", "refer", *AGENT_COLUMNS)
NARROW_LOG_COLUMNS = ("time", *AGENT_COLUMNS)
STORED_COLUMNS = ("ip", "formattime", *REQUEST_COLUMNS, "status", "bytesent", "refer", *AGENT_COLUMNS)
COLUMN_FAMILY = "O"
# --- End of fixed values ---

LINE = _strings("line")
WEB_LOG = _strings(*WEB_LOG_COLUMNS)
FORMATTED_LOG = _strings(*WEB_LOG_COLUMNS, "formattime")
STORED_ROW = _strings("rowkey", *STORED_COLUMNS, *PLACE_COLUMNS, "day")
AGENT_RULES = T.StructType([
    T.StructField("kind", T.StringType(), True),
    T.StructField("priority", T.IntegerType(), True),
    *_strings("token", "name", "detail").fields,
])
BROWSER_STAT = T.StructType([
    T.StructField("browsername", T.StringType(), True),
    T.StructField("cnt", T.IntegerType(), True),
    T.StructField("day", T.StringType(), True),
])
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
])
