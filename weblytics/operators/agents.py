"""Browser and operating system of each hit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblytics.functions.agents import (
    BROWSERS,
    SYSTEMS,
    BrowserRule,
    SystemRule,
    first_rule,
    rule_text,
    rule_version,
)
from weblytics.operators.lookup import by_distinct_key

MANY_RULES = 64


def _agent_columns(
    rows: DataFrame, browsers: Sequence[BrowserRule], systems: Sequence[SystemRule]
) -> DataFrame:
    agent, browser, system = F.col("agent"), F.col("_browser"), F.col("_system")
    chosen = rows.select(
        "*",
        first_rule(agent, browsers).alias("_browser"),
        first_rule(agent, systems).alias("_system"),
    )
    return chosen.select(
        *rows.columns,
        rule_text(browser, [r.name for r in browsers]).alias("browserName"),
        rule_version(agent, browser, browsers).alias("browserVersion"),
        rule_text(system, [r.family for r in systems]).alias("osName"),
        rule_text(system, [r.name for r in systems]).alias("osVersion"),
    )


def with_agents(
    rows: DataFrame,
    browsers: Sequence[BrowserRule] = BROWSERS,
    systems: Sequence[SystemRule] = SYSTEMS,
    distinct_first: bool | None = None,
    staged: bool = False,
) -> DataFrame:
    """Add the four agent columns from ``agent``.

    A short rule list is one CASE expression inside the scan stage: no join, no shuffle. With a
    long one each distinct agent is matched once and joined back, from rows written first if
    ``staged``. A stream always takes the first form.
    """
    if distinct_first is None:
        distinct_first = len(browsers) + len(systems) > MANY_RULES and not rows.isStreaming
    if not distinct_first:
        return _agent_columns(rows, browsers, systems)
    return by_distinct_key(
        rows, "agent", lambda agents: _agent_columns(agents, browsers, systems), staged=staged
    )
