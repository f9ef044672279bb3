"""Column helpers on text: regex capture, request split, key hash."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: the access-log line, nine groups ---
# ip? client user [time] "request" status bytes "referer" "agent"
_OCTETS = r"(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})?"
_CLIENT = r"(\S+)"
_USER = r"(\S+)"
_TIME = r"(\[.+?\])"
_REQUEST = r'"(.*?)"'
_STATUS = r"(\d{3})"
_BYTES = r"(\S+)"
_REFERER = r'"(.*?)"'
_AGENT = r'"(.*)"'  # ends the line, so a greedy group takes the same text as a lazy one
# --- End of fixed values ---

LINE_PATTERN = " ".join(
    (_OCTETS, _CLIENT, _USER, _TIME, _REQUEST, _STATUS, _BYTES, _REFERER, _AGENT)
)
WHOLE_LINE_PATTERN = rf"^{LINE_PATTERN}\z"
UNKNOWN = "unknown"

_KEPT_GROUPS = (1, 4, 5, 6, 7, 8, 9)
PART_NAMES = ("ip", "time", "request", "status", "bytesent", "refer", "agent")


MATCH_MARK = "\n"
PART_MARK = "\r"


def marked_parts(line: Column) -> Column:
    """The groups in ``PART_NAMES`` as one text with marks, or the line itself if it does not match.

    Neither mark can occur in a group, because ``.`` and ``\\S`` exclude both.
    """
    template = MATCH_MARK + PART_MARK.join(f"${g}" for g in _KEPT_GROUPS)
    return F.regexp_replace(line, F.lit(WHOLE_LINE_PATTERN), F.lit(template))


def request_parts(request: Column) -> Column:
    """Request text split on single spaces, trailing empty tokens dropped."""
    return F.split(F.rtrim(request), " ")


def null_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def joined_text(*parts: Column) -> Column:
    """Concatenation in which a null reads as the text ``null``."""
    return F.concat(*[F.coalesce(p, F.lit("null")) for p in parts])


def info_hash(info: Column) -> Column:
    """CRC-32 of the UTF-8 bytes as a BIGINT; 0 for empty or null text."""
    return F.when(F.length(info) > 0, F.crc32(info)).otherwise(F.lit(0).cast("bigint"))


def row_key(day: Column, hashed: Column) -> Column:
    """``<day>_<hash>``."""
    return F.concat(day, F.lit("_"), hashed.cast("string"))


def ip_number(ip: Column) -> Column:
    """IPv4 text as a BIGINT; null unless it is four octets of 0 to 255."""
    parts = F.split(ip, r"\.")
    octets = [F.get(parts, F.lit(i)).try_cast("bigint") for i in range(4)]
    valid = reduce(lambda acc, o: acc & o.between(0, 255), octets, F.size(parts) == 4)
    number = reduce(lambda acc, o: acc * 256 + o, octets)
    return F.when(valid, number)
