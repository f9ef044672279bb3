"""Connected components of a link table, by smallest labels and pointer jumping, on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblytics.llm.common import written

SALTS = 16


def smallest_labels(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, label`` where ``label`` is the least ``(rank, node)`` that links can reach.

    ``nodes`` is (node, rank), each node once; ``links`` is (a, b) in either direction, at most as many
    for one node as the caller bounds. Each round takes the least label of the neighbours, by an
    aggregate with a map-side part, and then the label of the label; rounds grow with the logarithm
    of the longest path. Many nodes share a label, so that join is salted.
    """
    both = written(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where(F.col("a") != F.col("b"))
        .distinct(),
        "links",
    )
    labels = written(nodes.select("node", F.struct("rank", "node").alias("label")), "labels")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    while True:
        heard = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("heard"))
        )
        step = labels.join(heard, "node", "left").select(
            "node",
            F.col("label").alias("old"),
            F.least("label", F.coalesce("heard", "label")).alias("label"),
        )
        target = labels.select(
            F.col("node").alias("to"), F.col("label").alias("far"), salts.alias("salt")
        )
        jumped = step.withColumns(
            {"to": F.col("label.node"), "salt": F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")}
        ).join(target, ["to", "salt"])
        new = written(
            jumped.select("node", "old", F.least("label", "far").alias("label")), "labels"
        )
        if not new.where(F.col("label") != F.col("old")).head(1):
            return new.select("node", "label")
        labels = new.select("node", "label")
