"""User-agent rules."""

import pytest

from weblytics.functions.agents import BrowserRule, SystemRule
from weblytics.operators.agents import with_agents
from weblytics.schema import AGENT_COLUMNS

CASES = {
    "Mozilla/4.0 (compatible; MSIE 7.0; Windows NT 5.1; )": ("IE", "7.0", "Windows", "Windows XP"),
    "Mozilla/5.0 (Windows NT 6.1; Trident/7.0; rv:11.0) like Gecko": (
        "IE", "11.0", "Windows", "Windows 7",
    ),
    "Mozilla/5.0 (X11; Linux x86_64; rv:120.0) Gecko/20100101 Firefox/120.0": (
        "Firefox", "120.0", "Linux", "Linux",
    ),
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/119.0 Safari/537.36": ("Chrome", "119.0", "OS X", "OS X"),
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) Version/17.0 Safari/604.1": (
        "Safari", "17.0", "iOS", "iOS",
    ),
    "Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537.36 Edg/120.1": (
        "Edge", "120.1", "Windows", "Windows 10",
    ),
    "Mozilla/5.0 (compatible; Googlebot/2.1)": ("Googlebot", "2.1", "unknown", "unknown"),
    "Googlebot-Image": ("Googlebot", "unknown", "unknown", "unknown"),
    "Firefox/x": ("Firefox", "unknown", "unknown", "unknown"),
    "curl/8.0": ("unknown",) * 4,
    "": (None,) * 4,
    None: (None,) * 4,
}


@pytest.fixture
def agents(spark):
    return spark.createDataFrame([(a, i) for i, a in enumerate(CASES)], "agent string, n int")


def found(df):
    return {r["agent"]: tuple(r[c] for c in AGENT_COLUMNS) for r in df.collect()}


def test_shipped_rules(agents):
    assert found(with_agents(agents)) == CASES


def test_distinct_first_gives_the_same(agents):
    inline, looked_up = with_agents(agents), with_agents(agents, distinct_first=True)
    assert looked_up.columns == inline.columns
    assert found(looked_up) == CASES


def test_short_rule_list_needs_no_shuffle(agents, plan):
    assert "Exchange" not in plan(with_agents(agents))


def test_own_rules_first_match_wins(agents):
    browsers = [BrowserRule("curl", "curl", "curl/"), BrowserRule("8", "eight", "z")]
    rows = found(with_agents(agents, browsers, [SystemRule("curl", "f", "n")]))
    assert rows["curl/8.0"] == ("curl", "8.0", "f", "n")
    assert rows["Firefox/x"] == ("unknown",) * 4


def test_long_rule_list_takes_the_distinct_route(agents, plan):
    browsers = [BrowserRule(f"none-{i}", "x", "x") for i in range(80)]
    browsers.append(BrowserRule("curl", "curl", "curl/"))
    df = with_agents(agents, browsers)
    assert "BroadcastHashJoin" in plan(df)
    assert found(df)["curl/8.0"][:2] == ("curl", "8.0")


def test_only_the_name_is_worked_out_when_only_it_is_read(agents, plan):
    assert "regexp_extract" not in plan(with_agents(agents).select("browserName"))
