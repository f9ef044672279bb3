"""Operator 9, language ID: compression with zstandard raw-content dictionaries, one for each language.

A text is cut into blocks of ``BLOCK`` bytes; each block is compressed with each dictionary, and the sizes
are summed over the whole text. The smallest sum wins; a narrow margin is a rejection.

A short text alone is too small to compress, and its size is a few whole bytes. So where a text is short or its margin
narrow, its blocks are compressed behind several contexts of each language, and what they add is summed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblytics.llm.common import crc_of_id, texts

UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
OTHERS = re.compile(r"[\W\d_]+")
BLOCK = 4096
LEVEL = 5
FRAME = 8  # bytes of a frame that no text decides
DICTIONARY_BYTES = 64 << 10
CONTEXTS, CONTEXT_BYTES = 8, 1024
SHORT = 512  # letters and spaces; below it the contexts decide
SAMPLE_DOCUMENTS = 400  # distinct texts of each language, every other one for the contexts
DEALT = 64  # parts of a language's documents that are ranked apart before they are ranked together
SLICES = 4  # of each of them, spread over the whole text
LEAST_DICTIONARY = 8  # bytes below which zstandard takes no dictionary; shorter ones are repeated
MAX_LANGUAGES = 1000  # more are refused: each costs a dictionary and its contexts on the driver and in each task
NARROW = 0.005


class Language(NamedTuple):
    dictionary: bytes
    contexts: tuple[bytes, ...]


def _slices(text: Column, share: Column) -> Column:
    """``SLICES`` stretches from the first to the last character, ``share`` characters together; a shorter text whole."""
    width = F.ceil(share / SLICES).cast("int")
    over = F.char_length(text) - width
    places = F.transform(F.sequence(F.lit(0), F.lit(SLICES - 1)), lambda i: F.floor(i * over / (SLICES - 1)).cast("int") + 1)
    spread = F.array_join(F.transform(places, lambda at: F.substr(text, at, width)), " ")
    return F.when(F.char_length(text) <= share, text).otherwise(spread)


def learn(docs: DataFrame, lang_col: str = "lang", dictionary_bytes: int = DICTIONARY_BYTES, **names: str) -> dict[str, Language]:
    """A dictionary and contexts for each language, of equal shares of distinct texts.

    Learned from rows whose crc32 of the id is not 2 modulo 4, with a language and a letter. The sample is bounded:
    ``SAMPLE_DOCUMENTS`` texts of a language, in the order of a hash of the id, and of each its share of
    the bytes, in slices spread over the whole text. Equal texts count once, as do the rows of one id. Only ids and
    hashes are ranked. A language whose dictionary is shorter than zstandard takes has it repeated.
    """
    text_col, id_col = names.get("text_col", "text"), names.get("id_col", "doc_id")
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.pmod(crc_of_id(F.col("doc_id")), F.lit(4)) != 2)
    )
    if rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    hashed = rows.where(F.col("text").rlike(r"\p{L}")).withColumn("hash", F.xxhash64("text"))
    distinct = (
        hashed.groupBy("lang", "hash").agg(F.min("doc_id").alias("doc_id"))
        .groupBy("lang", "doc_id").agg(F.min("hash").alias("hash"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    dealt = Window.partitionBy("lang", F.pmod(F.xxhash64("doc_id"), F.lit(DEALT))).orderBy(*order)
    few = distinct.withColumn("turn", F.row_number().over(dealt)).where(F.col("turn") <= SAMPLE_DOCUMENTS)
    # So many of each part are enough: the ranking of a whole language sees DEALT times as many, whatever the input.
    ranked = Window.partitionBy("lang").orderBy(*order)
    chosen = few.withColumn("turn", F.row_number().over(ranked)).where(F.col("turn") <= SAMPLE_DOCUMENTS)
    counted = chosen.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("lang")))
    parted = counted.withColumn("for_context", (F.col("turn") % 2 == 0)).withColumn(
        "share",
        F.when(F.col("for_context"), F.ceil(F.lit(CONTEXTS * CONTEXT_BYTES) / F.floor(F.col("n") / 2))).otherwise(
            F.floor(F.lit(dictionary_bytes) / F.ceil(F.col("n") / 2))
        ).cast("int"),
    )
    found = (
        hashed.join(F.broadcast(parted), ["lang", "doc_id", "hash"])  # SAMPLE_DOCUMENTS rows a language
        .select("lang", "turn", "for_context", "share", _slices(F.col("text"), F.col("share")).alias("text"))
        .groupBy("lang", "turn", "for_context", "share").agg(F.min("text").alias("text"))  # repeated rows
        .collect()
    )
    parts: dict[tuple[str, bool], list[bytes]] = {}
    for row in sorted(found, key=lambda r: (r["lang"], r["turn"])):
        parts.setdefault((row["lang"], row["for_context"]), []).append(letters(row["text"])[: row["share"]])
    learned = {}
    for lang in {k for k, _ in parts}:
        dictionary = b" ".join(parts[lang, False])
        while len(dictionary) < LEAST_DICTIONARY:
            dictionary += b" " + dictionary
        beside = b" ".join(parts.get((lang, True), [dictionary])) + b" "
        beside *= -(-CONTEXTS * CONTEXT_BYTES // len(beside))
        contexts = [beside[i * CONTEXT_BYTES : (i + 1) * CONTEXT_BYTES] + b" " for i in range(CONTEXTS)]
        learned[lang] = Language(dictionary[:dictionary_bytes], tuple(contexts))
    return learned


def letters(text: str) -> bytes:
    """The text's words in lower case, with one space for all between them: case and signs are no language."""
    return OTHERS.sub(" ", text.lower()).encode()


class Classifier:
    """Compressors for each language; made once in each task."""

    def __init__(self, languages: dict[str, Language]) -> None:
        self.langs = sorted(languages)
        self.compressors, self.contexts = [], []
        for lang in self.langs:
            raw = zstandard.ZstdCompressionDict(languages[lang].dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            compressor = zstandard.ZstdCompressor(dict_data=raw, level=LEVEL, write_content_size=False, write_dict_id=False)
            self.compressors.append(compressor)
            self.contexts.append([(c, len(compressor.compress(c))) for c in languages[lang].contexts])

    def sizes(self, text: bytes) -> list[int]:
        """By language, the size of the text's blocks."""
        totals = [0] * len(self.langs)
        for i in range(0, len(text), BLOCK):
            block = text[i : i + BLOCK]
            for k, compressor in enumerate(self.compressors):
                totals[k] += len(compressor.compress(block)) - FRAME
        return totals

    def added(self, text: bytes) -> list[int]:
        """By language, what the text's blocks add to the size of each of its contexts."""
        totals = [0] * len(self.langs)
        for i in range(0, len(text), BLOCK):
            block = text[i : i + BLOCK]
            for k, compressor in enumerate(self.compressors):
                totals[k] += sum(len(compressor.compress(context + block)) - size for context, size in self.contexts[k])
        return totals

    def _ranked(self, sizes: list[int]) -> tuple[str, float]:
        order = sorted(range(len(sizes)), key=lambda k: (sizes[k], k))
        if len(order) == 1:
            return self.langs[0], 1.0
        best = max(1, sizes[order[0]])
        return self.langs[order[0]], 1.0 - best / max(best, sizes[order[1]])

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and margin, the share by which the next language is larger, 0 to 1."""
        if not text or not LETTER.search(text) or not self.langs:
            return UNKNOWN, 0.0
        plain = letters(text)
        if len(plain) >= SHORT:
            found = self._ranked(self.sizes(plain))
            if found[1] >= NARROW:
                return found
        return self._ranked(self.added(plain))


def predict_languages(
    docs: DataFrame, languages: dict[str, Language], narrow: float = NARROW, carried: Column | None = None, **names: str
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, lang_pred, margin, rejected; with ``carried``, it and text as well.

    A text that is null, empty or without a letter is ``und`` and rejected; so is any text if nothing was
    learned. A margin below ``narrow`` is rejected with its best language given; ties go to the first
    language by name. Null ids and repeated rows are scored like others, each row by itself. The dictionaries are a bounded
    sample and travel with the tasks.
    """
    source = texts(docs, carried=carried, **names)
    passing = [] if carried is None else ["text", "carried"]
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("margin", T.DoubleType()),
        *[source.schema[c] for c in passing],
    ])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(languages)
        for batch in batches:
            found = [classifier.predict(v.as_py()) for v in batch.column(1)]
            yield pa.record_batch(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 *[batch.column(k + 1) for k in range(len(passing))]],
                names=["doc_id", "lang_pred", "margin", *passing],
            )

    return source.mapInArrow(mapped, schema).withColumn(
        "rejected", (F.col("lang_pred") == UNKNOWN) | (F.col("margin") < narrow)
    )
