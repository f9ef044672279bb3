"""Operator 10, packing by power-of-two decomposition.

A document's tokens are cut into pieces of falling powers of two, 4096 at most: as many full pieces as
there are, then the binary digits of the rest. Pieces of one length are one bucket; each piece is a
sequence, so nothing is padded and no sequence crosses documents. Sequence ids follow the buckets.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblytics.llm.common import numbered, texts, written

MAX_TOKENS = 4096
END_ID = 2
CACHED_WORDS = 500_000  # in each of two halves, for each Python worker
LONGEST_CACHED = 64
WORD_END = "</w>"  # fixed mark of this vocabulary
# Letters that NFC leaves alone and that lower one by one, then ASCII signs.
LETTERS_AND_SIGNS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
BREAKS = re.compile(r"[\t\n\r]")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Token ids of a text as little-endian 32-bit bytes, with a cache of words.

    This vocabulary drops white space and no token crosses it, so a text's ids are the ids of its
    space-separated words in order.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a word
        self.last[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}

    def _ids_of_each(self, words: list[str]) -> list[bytes]:
        """Ids of texts that are one word to the tokenizer each, encoded together and told apart by their last tokens."""
        if not words:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        edges = [0, *(np.flatnonzero(self.last[ids]) + 1).tolist()]
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(edges, edges[1:])]

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of new words. Letters alone are one word to the tokenizer, which lowers them, and so are the signs
        after them; such parts are looked up or encoded once, whatever words they occur in."""
        found, parts, letters, others = {}, {}, set(), []
        for word in words:
            match = LETTERS_AND_SIGNS.fullmatch(word)
            if match:
                stem, signs = match.groups()
                stem = stem.lower()
                parts[word] = stem, signs
                letters.add(stem)
                if signs:
                    letters.add(signs)
            elif word.isalpha() and word.lower().isalpha():
                letters.add(word)
            else:
                others.append(word)
        known, before = self.known, self.before
        new = []
        for part in letters:
            ids = known.get(part) or before.get(part)
            if ids:
                found[part] = ids
            else:
                new.append(part)
        found.update(zip(new, self._ids_of_each(new), strict=True))
        for word, (stem, signs) in parts.items():
            found[word] = found[stem] + found[signs] if signs else found[stem]
        if others:
            encoded = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
            found |= {w: np.array(e.ids, dtype="<u4").tobytes() for w, e in zip(others, encoded, strict=True)}
        return found

    def encode(self, text: str) -> bytes:
        words = BREAKS.sub(" ", text).split(" ")
        known, before = self.known, self.before
        missing = set(words).difference(known)
        if not missing:
            return b"".join(map(known.__getitem__, words))
        found = {w: before[w] for w in missing if w in before}
        if new := missing.difference(found):
            found |= self._learn(new)  # holds parts of words as well, which are words
        known.update(found)
        ids = b"".join(map(known.__getitem__, words))
        for word in [w for w in found if len(w) > LONGEST_CACHED]:
            del known[word]
        if len(known) >= CACHED_WORDS:  # the words in use move over from the older half
            self.before = known if len(known) < 2 * CACHED_WORDS else {}
            self.known = {"": b""}
        return ids


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def binary_lengths(n: int, longest: int = MAX_TOKENS) -> list[int]:
    """Falling powers of two that sum to ``n``: full pieces, then the binary digits of the rest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pieces(docs: DataFrame, path: str | None = None, longest: int = MAX_TOKENS, with_ids: bool = False, **names: str) -> DataFrame:
    """The pieces of each row: doc_id, start, length, ids_crc32, doc_tokens, and the ids if asked for."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    path = path or tokenizer_path()
    fields = [pa.field(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
    schema = pa.schema(fields + ([pa.field("ids", pa.list_(pa.int32()))] if with_ids else []))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = tokenizer.encode(text.as_py() or "") + end
                start = 0
                for length in binary_lengths(len(ids) // 4, longest):
                    part = ids[4 * start : 4 * (start + length)]
                    row = (doc_id, start, length, zlib.crc32(part), len(ids) // 4)
                    out.append((*row, np.frombuffer(part, "<i4")) if with_ids else row)
                    start += length
                if len(out) >= 4096:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    spark_schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return texts(docs, **names).mapInArrow(mapped, spark_schema + (", ids array<int>" if with_ids else ""))


def pack(docs: DataFrame, path: str | None = None, longest: int = MAX_TOKENS, with_ids: bool = False, **names: str) -> DataFrame:
    """One row for each piece: the columns of ``pieces``, sequence_id and offset.

    Ids end with the id 2; a null or empty text has that id alone. Sequence ids run from 0 without
    gaps, short buckets first, then by doc_id (nulls first) and start; pieces equal in all of these, of
    repeated rows, are interchangeable. An empty table gives no rows.
    """
    cut = written(pieces(docs, path, longest, with_ids, **names), "pieces")
    placed, _ = numbered(cut, ["length", "doc_id", "start"], "sequences")
    return placed.select(*cut.columns, F.col("row_number").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
