"""User-agent rules as data, and the columns they give."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from weblytics.functions.text import UNKNOWN


class BrowserRule(NamedTuple):
    token: str  # the agent contains this text
    name: str
    version_after: str  # digits and dots after this text are the version


class SystemRule(NamedTuple):
    token: str
    family: str
    name: str


# --- Fixed values: shipped rules, first match wins ---
BROWSERS: tuple[BrowserRule, ...] = (
    BrowserRule("Googlebot", "Googlebot", "Googlebot/"),
    BrowserRule("bingbot", "bingbot", "bingbot/"),
    BrowserRule("Baiduspider", "Baiduspider", "Baiduspider/"),
    BrowserRule("Edg/", "Edge", "Edg/"),
    BrowserRule("Edge/", "Edge", "Edge/"),
    BrowserRule("OPR/", "Opera", "OPR/"),
    BrowserRule("Opera", "Opera", "Opera/"),
    BrowserRule("MSIE ", "IE", "MSIE "),
    BrowserRule("Trident/", "IE", "rv:"),
    BrowserRule("Firefox/", "Firefox", "Firefox/"),
    BrowserRule("Chrome/", "Chrome", "Chrome/"),
    BrowserRule("Safari/", "Safari", "Version/"),
)
SYSTEMS: tuple[SystemRule, ...] = (
    SystemRule("Windows NT 10.0", "Windows", "Windows 10"),
    SystemRule("Windows NT 6.3", "Windows", "Windows 8.1"),
    SystemRule("Windows NT 6.2", "Windows", "Windows 8"),
    SystemRule("Windows NT 6.1", "Windows", "Windows 7"),
    SystemRule("Windows NT 6.0", "Windows", "Windows Vista"),
    SystemRule("Windows NT 5.1", "Windows", "Windows XP"),
    SystemRule("Windows", "Windows", "Windows"),
    SystemRule("Android", "Android", "Android"),
    SystemRule("iPhone", "iOS", "iOS"),
    SystemRule("iPad", "iOS", "iOS"),
    SystemRule("Mac OS X", "OS X", "OS X"),
    SystemRule("Linux", "Linux", "Linux"),
)
# --- End of fixed values ---

_NO_RULE = -1


def first_rule(agent: Column, rules: Sequence[NamedTuple]) -> Column:
    """Index of the first rule whose token occurs; -1 for none, null for an empty agent."""
    chosen = F.when(F.length(agent) == 0, F.lit(None).cast("int"))
    for index, rule in enumerate(rules):
        chosen = chosen.when(F.contains(agent, F.lit(rule.token)), index)
    return F.when(agent.isNotNull(), chosen.otherwise(_NO_RULE))


def rule_text(index: Column, texts: Sequence[str]) -> Column:
    """Text of the chosen rule; ``unknown`` for none."""
    chosen = F.get(F.array(*[F.lit(t) for t in texts]), index)
    return F.when(index == _NO_RULE, UNKNOWN).otherwise(chosen)


def text_version(agent: Column, mark: Column) -> Column:
    """Digits and dots that follow ``mark`` where it first occurs; null if there are none."""
    at = F.position(mark, agent)
    version = F.regexp_extract(F.substr(agent, at + F.length(mark)), "^[0-9.]+", 0)
    return F.when((at > 0) & (F.length(version) > 0), version)


def rule_version(agent: Column, index: Column, rules: Sequence[BrowserRule]) -> Column:
    """Version by the chosen rule; ``unknown`` for none, or where no version follows."""
    mark = F.get(F.array(*[F.lit(r.version_after) for r in rules]), index)
    version = F.when(index != _NO_RULE, text_version(agent, mark))
    return F.when(index.isNotNull(), F.coalesce(version, F.lit(UNKNOWN)))
