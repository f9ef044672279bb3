"""The corpus pipeline: language, exact copies, near copies, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet in the shared folder and
gives it, reread, to the next one. All stages but the last return the columns of ``docs``. An empty
table passes through every stage; rows of null text have no language and leave at the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblytics.llm import exact_dedup, lang_id, packing, simhash_ball, suffix_dedup
from weblytics.llm.common import ascii_lower, documents, ship, written

REJECT_MARGIN = lang_id.NARROW


def _row_name(row: Column, text: Column) -> Column:
    """SHA-256 of a row's id and text: a key that is never null, and hot for no id."""
    doc_id = F.coalesce(row["doc_id"].cast("string"), F.lit("null"))
    return F.unhex(F.sha2(F.concat(doc_id, F.lit(":"), F.coalesce(text, F.lit(""))), 256))


def _kept(docs: DataFrame, text: Column, names: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose name is in ``names.name``, each name once. Whole rows travel as one column.

    Repeats are dropped in each task before rows travel, so one row repeated however often leaves a task once.
    """
    row = F.col("row")
    named = docs.select(F.struct(*docs.columns).alias("row")).select("row", _row_name(row, text).alias("name"))
    return named.dropDuplicates(["name"]).join(names, "name", "left_semi").select("row.*")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the rows that language ID rejects: no letter, or a margin below ``REJECT_MARGIN``. Each row by itself."""
    ship(spark)
    others = [c for c in docs.columns if c != "text"]
    beside = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)])
    found = lang_id.predict_languages(docs, lang_id.learn(docs), REJECT_MARGIN, carried=beside)
    columns = {c: F.col(f"carried.c{i}") for i, c in enumerate(others)} | {"text": F.col("text")}
    return found.where(~F.col("rejected")).select(*[columns[c].alias(c) for c in docs.columns])


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the largest id of each group of equal texts, once; nulls are the smallest ids."""
    stay = exact_dedup.exact_groups(docs).where("kept").select(
        _row_name(F.struct("doc_id"), F.col("text_sha256")).alias("name")
    )
    content = F.sha2(ascii_lower(F.coalesce(F.col("row")["text"], F.lit(""))), 256)
    return _kept(docs, content, stay)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies: of the smallest id, null ids last, then by a hash of the text."""
    stay = simhash_ball.first_names(docs, _row_name(F.struct("doc_id"), F.col("text")), words=3, max_bits=3)
    return _kept(docs, F.col("row")["text"], stay)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that start in a document with a smaller id; every document stays.

    ``text`` is what is left, without the parts of characters cut in two; ``n_chars`` is its length in code
    points if that column exists. A null text stays null.
    """
    others = [c for c in docs.columns if c != "text"]
    beside = F.struct(
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], F.col("text").isNull().alias("no_text")
    )
    left = suffix_dedup.remove_repeats(docs, as_text=True, carried=beside)
    no_text = F.col("carried.no_text")
    columns = {c: F.col(f"carried.c{i}") for i, c in enumerate(others)} | {"text": F.when(~no_text, F.col("kept"))}
    if "n_chars" in columns:
        length = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(no_text, columns["n_chars"]).otherwise(length)
    return left.select(*[columns[c].alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces and their sequences, as operator 10 returns them."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("suffix_array_dedup", passage_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # compression sizes and a tokenizer have no SQL; tests hold brute force against run()


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
