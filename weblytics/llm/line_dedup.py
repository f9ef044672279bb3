"""Operator 4, line dedup: drop lines that several documents hold, but for the first document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblytics.llm.common import ascii_lower, join_counted, texts, written

WHITE = " \t\n\x0b\x0c\r"
NO_ID = (1 << 63) - 1


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def drop_shared_lines(
    docs: DataFrame, min_chars: int = 10, min_documents: int = 2, **names: str
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text (lines kept), n_lines, n_dropped.

    Lines with a key of ``min_chars`` code points held by ``min_documents`` documents or more stay
    only in the document with the smallest id. A null or empty text is one empty line, which is
    too short to drop. A null id counts as the largest. Rows with one id are one document: they
    lose or keep a line alike. An empty table gives no rows.

    Keys are compared by two 64-bit hashes and their length. A hash's smallest and largest document
    come from one aggregate with a map-side part; more than two documents are counted distinct only if asked
    for. Frequent hashes join by broadcast, the others by shuffle. Texts are shuffled once.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = texts(docs, **names).select(
        "doc_id",
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"),
        F.xxhash64(body).alias("mark"),
        body.alias("text"),
    )
    key = line_key(F.col("line"))
    lines = written(
        rows.select("id", "mark", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .withColumn("key", key)
        .where(F.char_length("key") >= min_chars)
        .select(
            "id", "mark", "pos",
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), "key").alias("h2"),
            F.char_length("key").alias("len"),
        ),
        "lines",
    )
    hashed = ["h1", "h2", "len"]
    if min_documents <= 2:
        shared = F.col("first") < F.col("last") if min_documents == 2 else F.lit(True)
        counts = lines.groupBy(*hashed).agg(
            F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")
        )
    else:
        shared = F.col("holders") >= min_documents
        counts = (
            lines.groupBy(*hashed, "id")
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy(*hashed)
            .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("holders"), F.sum("n").alias("n"))
        )
    repeated = written(counts.where(shared).select(*hashed, "first", "n"), "line-keys")
    dropped = (
        join_counted(lines, repeated, hashed)
        .where(F.col("id") != F.col("first"))
        .groupBy("id", "mark")
        .agg(F.collect_set("pos").alias("gone"))
    )
    parts = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), "gone")
    kept = F.transform(left, lambda i: F.get(F.col("parts"), i))
    return (
        rows.join(dropped, ["id", "mark"], "left")
        .withColumn("parts", parts)
        .select(
            "doc_id",
            F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
            F.size("parts").cast("bigint").alias("n_lines"),
            F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_dropped"),
        )
    )
