"""Operator 6, SentencePiece encoding and decoding: an Aho-Corasick automaton drives one Viterbi pass.

The automaton reports every piece that ends at a position, by its output links; each relaxes the best
score there. A character no piece reaches falls back to its UTF-8 bytes. Spaces become U+2581 and one is put
before the text. No piece of such a vocabulary has U+2581 after another character, so the best path of
a text is that of its words, each with the spaces before it, and words are cached.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weblytics.llm.common import texts

SPACE = "▁"
UNITS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
FALLBACK_PENALTY = 10.0
UNSET = -1e8  # scores below are placeholders; such pieces count as the least likely
CACHED_UNITS = 100_000  # in each of two halves, for each Python worker
LONGEST_CACHED = 64


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceCoder:
    def __init__(self, vocabulary: list[tuple[str, float]], byte_ids: list[int]) -> None:
        """``vocabulary``: piece and score by id ("" for ids that are no text); ``byte_ids``: of the 256 bytes."""
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        scores = [s for p, s in vocabulary if p and s > UNSET]
        least = min(scores, default=0.0)
        self.fallback = least - FALLBACK_PENALTY
        self.bytes_of = [p.replace(SPACE, " ").encode() for p, _ in vocabulary]
        for i, (piece, score) in enumerate(vocabulary):
            if piece:
                self.automaton.add_word(piece, (len(piece), score if score > UNSET else least, i))
        if not self.automaton.exists(SPACE):
            raise ValueError("the vocabulary has no piece for a space")  # its bytes would decode to U+2581
        self.automaton.make_automaton()
        self.byte_ids = byte_ids
        for value, i in enumerate(byte_ids):
            self.bytes_of[i] = bytes([value])
        self.by_unit = not any(SPACE in p.lstrip(SPACE) for p, _ in vocabulary)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def best_path(self, text: str) -> list[int]:
        """Ids of the path with the largest sum of scores; of equal ones the longest last piece."""
        n = len(text)
        best, back = [0.0], [None] * (n + 1)  # no piece: one character as bytes
        push, fallback, done = best.append, self.fallback, 0
        for end, piece in self.automaton.iter(text):
            while done <= end:
                push(best[done] + fallback)
                done += 1
            found = best[done - piece[0]] + piece[1]
            if found > best[done]:
                best[done] = found
                back[done] = piece
        ids: list[int] = []
        at = n
        while at:
            if piece := back[at]:
                ids.append(piece[2])
                at -= piece[0]
            else:
                ids += [self.byte_ids[b] for b in reversed(text[at - 1].encode())]
                at -= 1
        ids.reverse()
        return ids

    def _unit(self, unit: str) -> bytes:
        found = self.known.get(unit)
        if found is None:
            found = self.before.get(unit)
            if found is None:
                found = array("i", self.best_path(unit)).tobytes()
                if len(unit) > LONGEST_CACHED:
                    return found
            if len(self.known) >= CACHED_UNITS:  # the words in use move over from the older half
                self.before, self.known = self.known, {}
            self.known[unit] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; none for the empty text. A U+2581 in the text itself is written as bytes."""
        if not text:
            return np.empty(0, np.int32)
        mark = np.array([self.byte_ids[b] for b in SPACE.encode()], dtype="<i4").tobytes()
        out = []
        for k, part in enumerate(text.split(SPACE)):
            part = part.replace(" ", SPACE)
            if k:
                out.append(mark)
            else:
                part = SPACE + part
            out += map(self._unit, UNITS.findall(part) if self.by_unit else [part] if part else [])
        return np.frombuffer(b"".join(out), dtype="<i4")

    def decode(self, ids) -> str:
        """The text that ``encode`` was given."""
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()])[1:].decode("utf-8", "replace")


@lru_cache(maxsize=2)
def piece_coder(path: str) -> PieceCoder:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    text = lambda i: not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    vocabulary = [(model.id_to_piece(i) if text(i) else "", model.get_score(i)) for i in range(size)]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    return PieceCoder(vocabulary, byte_ids)


def encode_documents(docs: DataFrame, path: str | None = None, **names: str) -> DataFrame:
    """One row for each row: doc_id, ids, n_tokens, ids_crc32 (of 32-bit little-endian ids), round_trip.

    A null or empty text has no ids. ``round_trip`` says whether decoding gives the text back. Null ids
    and repeated rows are treated like others; an empty table gives no rows.
    """
    path = path or model_path()
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64()), ("round_trip", pa.bool_())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                ids, crcs, trips = [], [], []
                for value in batch.column(1):
                    text = value.as_py() or ""
                    found = coder.encode(text)
                    ids.append(found)
                    crcs.append(zlib.crc32(found.tobytes()))
                    trips.append(coder.decode(found) == text)
                sizes = [len(i) for i in ids]
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
                yield pa.record_batch(
                    [batch.column(0), lists, pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64()), pa.array(trips)], schema=schema
                )

    return texts(docs, **names).mapInArrow(
        mapped, "doc_id bigint, ids array<int>, n_tokens bigint, ids_crc32 bigint, round_trip boolean"
    )


def decode_documents(coded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids are no ids, the empty text."""
    path = path or model_path()

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(path)
        for batch in batches:
            out = [coder.decode(np.array(v.as_py() or [], dtype=np.int32)) for v in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(mapped, "doc_id bigint, text string")
