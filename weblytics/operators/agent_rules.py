"""Browser and operating system by a table of rules, however long.

Rules are rows ``(kind, priority, token, name, detail)``: a rule fits an agent that contains its token, and the fitting
rule of the least priority wins. ``kind`` is ``browser`` (``detail`` is the text that the version follows) or
``system`` (``name`` is the family, ``detail`` the full name).

Rules are found through an inverted index. A token contains any agent that it fits has all of the token's grams, so
one gram of each token, the one that fewest tokens have, is its anchor. Agents are cut into grams, joined to the
anchors by equality, and only those few pairs are tested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblytics.functions.agents import BROWSERS, SYSTEMS, text_version
from weblytics.functions.text import UNKNOWN
from weblytics.operators.lookup import BROADCAST_BYTES, by_distinct_key, row_bytes
from weblytics.schema import AGENT_RULES

GRAM = 4  # characters; a shorter token is its own gram
SALTS = 16  # tasks among which the agents of one gram are dealt if the rules are too many to broadcast
BROWSER, SYSTEM = "browser", "system"


def shipped_rules(spark: SparkSession, first_priority: int = 0) -> DataFrame:
    """The shipped rules as a table, in their order."""
    rows = [(BROWSER, first_priority + i, r.token, r.name, r.version_after) for i, r in enumerate(BROWSERS)]
    rows += [(SYSTEM, first_priority + i, r.token, r.family, r.name) for i, r in enumerate(SYSTEMS)]
    return spark.createDataFrame(rows, AGENT_RULES)


def _grams(text: Column, size: Column | int) -> Column:
    """Distinct stretches of ``size`` characters; none if the text is shorter."""
    size = F.lit(size) if isinstance(size, int) else size
    last = F.char_length(text) - size + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda at: F.substr(text, at, size)))


def rule_index(rules: DataFrame) -> DataFrame:
    """The rules with ``gram``, the anchor of the token. Rules without a token fit nothing and are left out."""
    usable = rules.select(*AGENT_RULES.names).where(F.char_length("token") > 0)
    tokens = usable.select("token").distinct()
    size = F.least(F.lit(GRAM), F.char_length("token"))
    grams = tokens.select("token", F.explode(_grams(F.col("token"), size)).alias("gram"))
    shared = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    anchors = grams.join(shared, "gram").groupBy("token").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    return usable.join(anchors, "token")


def _cut(agents: DataFrame, sizes: list[int]) -> DataFrame:
    """One row for each agent and distinct gram of the sizes that occur; an agent without any has a null gram."""
    grams = F.flatten(F.array(*[_grams(F.col("agent"), size) for size in sizes]))
    return agents.select("agent", "hits", F.explode_outer(grams).alias("gram"))


def match_agents(agents: DataFrame, index: DataFrame, sizes: list[int], small: bool) -> DataFrame:
    """``(agent, hits)``, each agent once, with its least browser and system rule as structs, null where none fits."""
    cut = _cut(agents, sizes)
    if small:
        pairs = cut.join(F.broadcast(index), "gram", "left")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        salted = cut.withColumn("salt", F.pmod(F.xxhash64("agent"), F.lit(SALTS)).cast("int"))
        pairs = salted.join(index.withColumn("salt", salts).hint("merge"), ["gram", "salt"], "left")

    def least(kind: str) -> Column:
        fits = (F.col("kind") == kind) & F.contains("agent", "token")
        return F.min(F.when(fits, F.struct("priority", "token", "name", "detail"))).alias(f"_{kind}")

    return pairs.groupBy("agent", "hits").agg(least(BROWSER), least(SYSTEM))


def _columns(matched: DataFrame) -> DataFrame:
    browser, system, agent = F.col(f"_{BROWSER}"), F.col(f"_{SYSTEM}"), F.col("agent")
    given = F.char_length("agent") > 0
    version = text_version(agent, browser["detail"])
    return matched.select(
        "agent",
        "hits",
        F.when(given, F.coalesce(browser["name"], F.lit(UNKNOWN))).alias("browserName"),
        F.when(given, F.coalesce(version, F.lit(UNKNOWN))).alias("browserVersion"),
        F.when(given, F.coalesce(system["name"], F.lit(UNKNOWN))).alias("osName"),
        F.when(given, F.coalesce(system["detail"], F.lit(UNKNOWN))).alias("osVersion"),
    )


def with_agent_rules(
    rows: DataFrame, rules: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, staged: bool = False
) -> DataFrame:
    """Add the four agent columns from ``agent``, by a rule table.

    Each distinct agent is matched once and joined back. Null and empty agents give nulls, agents that no rule fits
    ``unknown``. Rules of one kind and priority are ordered by token, name and detail. The rules are measured:
    broadcast up to ``broadcast_bytes``, else joined by shuffle with the agents of each gram dealt among tasks.
    """
    index = rule_index(rules)
    measured = index.agg(
        F.sum(row_bytes(index)).alias("bytes"), F.collect_set(F.char_length("gram")).alias("sizes")  # at most GRAM sizes
    ).first()
    sizes, small = sorted(measured["sizes"]) or [GRAM], (measured["bytes"] or 0) <= broadcast_bytes
    return by_distinct_key(
        rows, "agent", lambda agents: _columns(match_agents(agents, index, sizes, small)), broadcast_bytes, staged
    )
