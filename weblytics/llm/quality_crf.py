"""Operator 5, quality classifier: a linear-chain conditional random field over the lines of a document.

Each line is good or bad. Its score is linear in its own features and those of its neighbours; neighbouring
states are tied by a transition matrix. Forward and backward passes give each line's chance to be
good, and the mean of these, weighted by line length, is the document's quality.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblytics.llm.common import crc_of_id, texts

TRAIN_DOCUMENTS = 3000  # the bounded sample that the field is fitted on
TRAIN_LINES = 200  # neighbouring lines of each of those documents at most, from a place anywhere in it
STEPS = 300
RATE = 0.05
PENALTY = 1e-3

UPPER, LOWER, DIGIT, SPACE, STOP, MARK, SYMBOL, HIGH = range(8)
CLASSES = np.full(256, SYMBOL, np.uint8)
for _byte in range(256):
    _char = chr(_byte)
    if _byte >= 128:
        CLASSES[_byte] = HIGH
    elif _char.isupper():
        CLASSES[_byte] = UPPER
    elif _char.islower():
        CLASSES[_byte] = LOWER
    elif _char.isdigit():
        CLASSES[_byte] = DIGIT
    elif _char.isspace():
        CLASSES[_byte] = SPACE
    elif _char in ".?":
        CLASSES[_byte] = STOP
    elif _char in ",;:'\"()-":
        CLASSES[_byte] = MARK
OWN = 14  # features of a line itself
WIDTH = 3 * OWN + 3  # with those of both neighbours, first, last and a constant


def _words(line: bytes) -> tuple[float, float, float, float]:
    words = line.split()
    n = len(words)
    if not n:
        return 1.0, 0.0, 0.0, 0.0
    distinct = len(set(words))
    repeats = sum(map(eq, words, words[1:]))
    return distinct / n, repeats / n, min((len(line) - n + 1) / n / 10, 3.0), distinct / (n + 20)


def own_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line of a text, and the weight of each line, its bytes plus one."""
    lines = text.split(b"\n")
    raw = np.frombuffer(text, np.uint8)
    sizes = np.array([len(x) for x in lines], np.int64)
    owner = np.repeat(np.arange(len(lines)), sizes + 1)[: len(raw)]  # a line break belongs to its line
    counts = np.bincount(owner * 8 + CLASSES[raw], minlength=8 * len(lines)).reshape(-1, 8).astype(float)
    whole = np.maximum(sizes, 1).astype(float)
    letters = np.maximum(counts[:, UPPER] + counts[:, LOWER] + counts[:, HIGH], 1)
    out = np.empty((len(lines), OWN))
    out[:, 0] = np.log1p(sizes) / 8
    out[:, 1] = sizes == 0
    out[:, 2] = counts[:, UPPER] / letters
    out[:, 3] = counts[:, DIGIT] / whole
    out[:, 4] = counts[:, SYMBOL] / whole
    out[:, 5] = counts[:, MARK] / whole
    out[:, 6] = counts[:, STOP] / whole
    out[:, 7] = np.minimum(counts[:, SPACE] / whole, 1)
    out[:, 8] = counts[:, SYMBOL] > 0.02 * whole
    out[:, 9:13] = [_words(x) for x in lines]
    out[:, 13] = [0.0] + [float(bool(a) and a == b) for a, b in zip(lines, lines[1:])]
    return out, sizes + 1.0


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line with those of the lines before and after, and the lines' weights."""
    own, weights = own_features(text)
    none = np.zeros((1, OWN))
    ends = np.zeros((len(own), 3))
    ends[0, 0] = ends[-1, 1] = 1
    ends[:, 2] = 1
    return np.hstack([own, np.vstack([none, own[:-1]]), np.vstack([own[1:], none]), ends]), weights


def good_chances(emission: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Chance that each line is good, by forward and backward passes over log-odds.

    ``emission`` is the score of good over bad for each line, ``transition[a, b]`` that of b after a.
    """
    (bad_bad, bad_good), (good_bad, good_good) = np.exp(transition).tolist()
    x = emission.tolist()

    def pass_over(scores: list[float], enter: float, leave: float) -> np.ndarray:
        # Log-odds of good at a line from all lines on one side, without its own score.
        out, carried = [0.0], 0.0
        for score in scores[:-1]:
            odds = carried + score
            high = max(odds, 0.0)
            bad, good = exp(-high), exp(odds - high)
            carried = log((bad * enter + good * good_good) / (bad * bad_bad + good * leave))
            out.append(carried)
        return np.array(out)

    before = pass_over(x, bad_good, good_bad)
    after = pass_over(x[::-1], good_bad, bad_good)[::-1]
    return 1 / (1 + np.exp(-np.clip(emission + before + after, -500, 500)))


@dataclass
class Field:
    """A fitted field: scaling, weights of good over bad, transitions."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    transition: np.ndarray

    def emission(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.spread) @ self.weights

    def score(self, text: bytes) -> float:
        features, weights = line_features(text)
        chances = good_chances(self.emission(features), self.transition)
        return float(min(1.0, max(0.0, (chances * weights).sum() / weights.sum())))


def fit(documents: list[tuple[np.ndarray, int]]) -> Field:
    """Fit by gradient ascent on the chain likelihood; each line carries its document's label.

    ``documents`` holds line features and labels. Documents of the rarer label weigh more, up to
    equal totals. Without both labels the field is flat and scores 0.5.
    """
    labels = np.array([y for _, y in documents], float)
    if not len(labels) or labels.min() == labels.max():
        return Field(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), np.zeros((2, 2)))
    n, longest = len(documents), max(len(f) for f, _ in documents)
    flat = np.vstack([f for f, _ in documents])
    mean, spread = flat.mean(0), flat.std(0)
    mean[-1], spread[-1] = 0, 1
    spread[spread < 1e-9] = 1
    lines = np.array([len(f) for f, _ in documents])
    owner = np.repeat(np.arange(n), lines)
    place = np.concatenate([np.arange(k) for k in lines])
    x = (flat - mean) / spread
    share = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (n - labels.sum()))
    weight = (share / lines)[owner]
    y = labels[owner]
    real = np.zeros((longest, n), bool)
    real[place, owner] = True
    pairs = real[1:]
    theta, moves = np.zeros(WIDTH), np.zeros((2, 2))
    state = [np.zeros(WIDTH), np.zeros(WIDTH), np.zeros((2, 2)), np.zeros((2, 2))]
    for step in range(1, STEPS + 1):
        scores = np.zeros((longest, n, 2))
        scores[place, owner, 1] = x @ theta
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[0] = scores[0]
        for t in range(1, longest):
            to = np.logaddexp(forward[t - 1][:, :1] + moves[0], forward[t - 1][:, 1:] + moves[1])
            forward[t] = np.where(real[t][:, None], to + scores[t], forward[t - 1])
        for t in range(longest - 2, -1, -1):
            ahead = scores[t + 1] + backward[t + 1]
            back = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
            backward[t] = np.where(real[t + 1][:, None], back, backward[t])
        total = np.logaddexp(forward[-1][:, 0], forward[-1][:, 1])
        chance = np.exp(forward[place, owner, 1] + backward[place, owner, 1] - total[owner])
        grad = x.T @ (weight * (y - chance)) - PENALTY * theta
        joint = np.exp(
            forward[:-1][:, :, :, None] + moves + (scores[1:] + backward[1:])[:, :, None, :] - total[:, None, None]
        ) * (pairs * (share / lines))[:, :, None, None]
        seen = np.zeros((2, 2))
        np.add.at(seen, (labels.astype(int),) * 2, pairs.sum(0) * share / lines)
        pull = seen - joint.sum((0, 1)) - 0.05 * moves
        for k, (value, slope) in enumerate(((theta, grad), (moves, pull))):
            m, v = state[2 * k], state[2 * k + 1]
            m += 0.1 * (slope - m)
            v += 0.01 * (slope**2 - v)
            value += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(mean, spread, theta, moves)


def held_out(doc_id) -> object:
    return F.pmod(crc_of_id(doc_id), F.lit(3)) == 1


def training_lines(doc_id: int, features: np.ndarray) -> np.ndarray:
    """``TRAIN_LINES`` neighbouring lines of a document, or all of a shorter one."""
    places = max(0, len(features) - TRAIN_LINES) + 1
    first = crc32(str(doc_id).encode()) % places
    return features[first : first + TRAIN_LINES]


def learn(docs: DataFrame, labels: DataFrame, train_documents: int = TRAIN_DOCUMENTS, **names: str) -> Field:
    """Fit on ``train_documents`` labelled documents of the training fold, in the order of a hash of the id.

    Labels are (doc_id, quality); null labels, ids and the held-out fold are left out. An id on several rows gives
    one of them, the least text, and one label, the least. Features are computed in tasks, over whole texts; of a document
    with more than ``TRAIN_LINES`` lines so many neighbouring ones come to the driver, from a place that a hash
    of its id picks among all.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("y")).where(
        F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    )
    chosen = known.groupBy("doc_id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_documents)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (i, training_lines(i, line_features(t.as_py() or b"")[0]).astype("<f8").tobytes(), y)
                for i, t, y in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2).to_pylist())
            ]
            yield pa.record_batch(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.binary(), pa.int32()))],
                names=["doc_id", "features", "y"],
            )

    found = (
        texts(docs, **names)
        .join(F.broadcast(chosen), "doc_id")  # train_documents rows
        .groupBy("doc_id", "y").agg(F.min("text").alias("text"))
        .select("doc_id", "text", "y")
        .mapInArrow(mapped, "doc_id bigint, features binary, y int")
        .collect()
    )
    rows = sorted((r["doc_id"], bytes(r["features"]), r["y"]) for r in found)
    return fit([(np.frombuffer(f, "<f8").reshape(-1, WIDTH), y) for _, f, y in rows])


def score_documents(docs: DataFrame, field: Field, **names: str) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score, predicted.

    A null or empty text is one empty line and is scored as such. A null id is not held out. Repeated rows
    have equal scores. An empty table gives no rows. Only the text enters the score.
    """

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [field.score(t.as_py() or b"") for t in batch.column(1).cast(pa.binary())]
            yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return (
        texts(docs, **names)
        .mapInArrow(mapped, "doc_id bigint, score double")
        .select(
            "doc_id",
            F.coalesce(held_out(F.col("doc_id")) & F.col("doc_id").isNotNull(), F.lit(False)).alias("held_out"),
            "score",
            (F.col("score") >= 0.5).cast("int").alias("predicted"),
        )
    )
