"""Time helpers that give UTC results whatever the session time zone is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: time formats ---
LOG_TIME_FORMAT = "d/MMM/yyyy:H:m:s Z"
# --- End of fixed values ---


def seconds_to_ntz(seconds: Column) -> Column:
    """Epoch seconds as a TIMESTAMP_NTZ in UTC."""
    days = F.floor(seconds / 86400).cast("int")
    rest = (seconds - days.cast("bigint") * 86400).cast("decimal(18,6)")
    epoch = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return epoch + F.make_dt_interval(days, F.lit(0), F.lit(0), rest)


def seconds_text(seconds: Column) -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss`` in UTC."""
    return seconds_to_ntz(seconds).cast("string")


def log_instant(time: Column) -> Column:
    """``[29/Nov/2015:03:50:05 +0800]`` as an instant; null where it is no such time."""
    return F.try_to_timestamp(F.regexp_extract(time, r"\[(.*)\]", 1), F.lit(LOG_TIME_FORMAT))


def minute_text(seconds: Column) -> Column:
    """Epoch seconds as ``yyyyMMddHHmm`` in UTC, as one number: cheaper than text pieces."""
    minutes = F.floor(seconds / 60)
    day = F.date_from_unix_date(F.floor(minutes / 1440).cast("int"))
    of_day = F.pmod(minutes, F.lit(1440))
    date = (F.year(day).cast("bigint") * 100 + F.month(day)) * 100 + F.day(day)
    number = date * 10000 + F.floor(of_day / 60) * 100 + of_day % 60
    return F.lpad(number.cast("string"), 12, "0")


def format_time(time: Column) -> Column:
    """Log time as ``yyyyMMddHHmm`` in UTC."""
    return minute_text(F.unix_seconds(log_instant(time)))


def ntz_day(ts: Column) -> Column:
    """Day of a TIMESTAMP_NTZ as ``yyyyMMdd``."""
    return F.translate(ts.cast("date").cast("string"), "-", "")


def ntz_seconds(ts: Column) -> Column:
    """Epoch seconds of a TIMESTAMP_NTZ read as UTC."""
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return ((days * 24 + F.hour(ts)) * 60 + F.minute(ts)) * 60 + F.second(ts)


def ntz_instant(ts: Column) -> Column:
    """TIMESTAMP_NTZ read as UTC, as a TIMESTAMP (watermarks need one)."""
    micros = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint") % 1_000_000
    return F.timestamp_micros(ntz_seconds(ts) * 1_000_000 + micros)


def seconds_of(df: DataFrame, column: str) -> Column:
    """Epoch seconds of a timestamp column of either kind."""
    kind = df.select(column).schema[0].dataType
    if isinstance(kind, T.TimestampNTZType):
        return ntz_seconds(F.col(column))
    return F.unix_seconds(F.col(column))
