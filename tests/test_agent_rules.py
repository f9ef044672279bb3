import random

import pytest
from pyspark.sql import functions as F

from weblytics.functions.agents import BROWSERS, SYSTEMS
from weblytics.operators.agent_rules import GRAM, rule_index, shipped_rules, with_agent_rules
from weblytics.operators.agents import with_agents
from weblytics.schema import AGENT_COLUMNS, AGENT_RULES


def brute(agent, rules):
    if not agent:
        return (None,) * 4
    out = []
    for kind in ("browser", "system"):
        fitting = [r for r in rules if r[0] == kind and r[2] and r[2] in agent]
        found = min(fitting, key=lambda r: r[1:], default=None)
        if kind == "browser":
            version = ""
            if found and found[4] in agent:
                for c in agent[agent.index(found[4]) + len(found[4]):]:
                    if c not in "0123456789.":
                        break
                    version += c
            out += [found[3] if found else "unknown", version or "unknown"]
        else:
            out += [found[3], found[4]] if found else ["unknown", "unknown"]
    return tuple(out)


def many_rules(rng, n):
    letters = "abcdeAB/ ."
    rules = []
    for k in range(n):
        token = "".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))
        rules.append((rng.choice(["browser", "system"]), rng.randint(0, 400), token, f"name {k}", rng.choice(["/", "x", token])))
    return rules


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_against_all_rules(spark, plan, broadcast_bytes):
    rng = random.Random(8)
    rules = many_rules(rng, 900) + [("browser", 1, None, "none", "/"), ("system", 1, "", "empty", "empty")]
    agents = ["".join(rng.choice("abcdeAB/ .12") for _ in range(rng.randint(0, 40))) for _ in range(200)]
    agents += [None, "", "a", "ab", "zzzz", "\U0001f642a/1.5"] + agents[:30]
    rows = spark.createDataFrame([(a, k) for k, a in enumerate(agents)], "agent string, k int")
    found = with_agent_rules(rows, spark.createDataFrame(rules, AGENT_RULES), broadcast_bytes)
    got = {r["k"]: tuple(r[c] for c in AGENT_COLUMNS) for r in found.collect()}
    assert got == {k: brute(a, rules) for k, a in enumerate(agents)}
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)


def test_shipped_rules_as_a_table(spark):
    """The table form equals the expression form."""
    agents = [r.token + r.version_after + "1.2" for r in BROWSERS] + [r.token for r in SYSTEMS] + ["curl/8", "", None]
    rows = spark.createDataFrame([(a,) for a in agents], "agent string")
    table = with_agent_rules(rows, shipped_rules(spark)).select("agent", *AGENT_COLUMNS)
    assert sorted(map(repr, table.collect())) == sorted(map(repr, with_agents(rows).select("agent", *AGENT_COLUMNS).collect()))


def test_anchors_are_rare(spark):
    """The gram that all tokens share is the anchor of none."""
    rules = [("browser", k, f"Common/{k:05d};", "n", "/") for k in range(5000)]
    index = rule_index(spark.createDataFrame(rules, AGENT_RULES))
    per_gram = index.groupBy("gram").count().agg(F.max("count").alias("most"), F.count(F.lit(1)).alias("grams")).first()
    assert index.count() == 5000 and per_gram["most"] <= 50
    assert index.where(F.char_length("gram") != GRAM).count() == 0


def test_no_rules(spark):
    rows = spark.createDataFrame([("Firefox/1",), ("",)], "agent string")
    found = with_agent_rules(rows, spark.createDataFrame([], AGENT_RULES)).collect()
    assert {r["agent"]: r["browserName"] for r in found} == {"Firefox/1": "unknown", "": None}
