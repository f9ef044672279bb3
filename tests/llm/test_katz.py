"""Operator 12 against counts kept in plain dictionaries."""

import random
import zlib
from collections import Counter
from math import isclose, log10

import numpy as np
import pytest
from helpers import hard_rows, table
from pyspark.sql import functions as F

from weblytics.llm import katz as K

END, START = object(), object()


def words_of(text):
    return (text or "").encode().lower().split()


class Brute:
    def __init__(self, texts):
        self.uni, self.pairs, self.after = Counter(), Counter(), {}
        for text in texts:
            before = START
            for word in [*words_of(text), END]:
                self.uni[word] += 1
                self.pairs[before, word] += 1
                self.after.setdefault(before, set()).add(word)
                before = word
        self.documents = len(texts)
        self.n = sum(self.uni.values())
        self.kept_word = {w: c * self.ratio(c, self.uni) for w, c in self.uni.items()}
        self.unseen = 1 - sum(self.kept_word.values()) / max(self.n, 1)

    @staticmethod
    def ratio(r, counts):
        of = Counter(counts.values())
        turing = (r + 1) * of[r + 1] / (r * of[r]) if r <= 5 else 0
        return turing if 0 < turing < 1 else r / (r + 1)

    def word(self, word):
        if not self.n:
            return 1.0
        return self.kept_word[word] / self.n if word in self.uni else self.unseen

    def pair(self, before, word):
        of = self.documents if before is START else self.uni.get(before, 0)
        if (before, word) in self.pairs:
            c = self.pairs[before, word]
            return self.ratio(c, self.pairs) * c / of
        return (self.weight(before) if of else 1.0) * self.word(word)

    def weight(self, before):
        of = self.documents if before is START else self.uni[before]
        seen = self.after[before]
        kept = sum(self.ratio(self.pairs[before, w], self.pairs) * self.pairs[before, w] for w in seen) / of
        return (1 - kept) / (1 - sum(self.word(w) for w in seen))

    def score(self, text):
        total, before = 0.0, START
        for word in [*words_of(text), END]:
            total += log10(self.pair(before, word))
            before = word
        return total


def learns(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 != 2


@pytest.mark.parametrize(("block", "bucket", "partitions"), [(2_000_000, 500_000, 2), (500, 300, 5), (1, 40, 1)])
def test_against_dictionaries(spark, block, bucket, partitions):
    rows = hard_rows() + [(1000 + k, t) for k, t in enumerate(["the the the", "of  the x   y", "New unseen words ÄB äb", "\x00 a\x1fb", "x"] * 6)]
    brute = Brute([t for i, t in rows if learns(i)])
    found = K.score_documents(table(spark, rows, partitions), K.learned_documents(F.col("doc_id")), block, bucket).collect()
    got = sorted([tuple(r) for r in found], key=lambda r: (repr(r[:4]), r[5], r[6]))
    expected = []
    for i, t in rows:
        tokens = [*words_of(t), END]
        base = sum(log10((brute.uni[w] + 1) / (brute.n + len(brute.uni) + 1)) for w in tokens)
        known = sum(w in brute.uni for w in tokens)
        expected.append((i, learns(i), len(tokens), known, brute.n, base, brute.score(t)))
    expected.sort(key=lambda r: (repr(r[:4]), r[5], r[6]))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for a, b in zip(got, expected):
        assert isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-12) and isclose(a[6], b[6], rel_tol=1e-9, abs_tol=1e-12)


def test_chances_sum_to_one():
    brute = Brute([t for _, t in hard_rows()])
    for before in [START, *list(brute.after)[:40]]:
        if before is not END:
            total = sum(brute.pair(before, w) for w in brute.uni) + brute.pair(before, b"never seen")
            assert isclose(total, 1, rel_tol=1e-9)


def test_nothing_to_learn_from_and_no_rows(spark):
    rows = [(1, "some words"), (2, None)]
    got = K.score_documents(table(spark, rows), F.lit(False)).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got] == [(3, 0, 0, 0, 0), (1, 0, 0, 0, 0)]
    assert K.score_documents(table(spark, []), F.lit(True)).count() == 0


def test_columns_as_bytes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        values = rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2)
        assert (K.unpack(K.pack(values)) == values).all()
        values.sort()
        assert (K.unpack_sorted(K.pack_sorted(values)) == values).all()
    parts = [b"", b"abc", b"\x00" * 9]
    assert K.split_parts(K.join_parts(*parts), 3) == parts


def test_discounts_leave_a_chance():
    rng = random.Random(4)
    for _ in range(50):
        of = [0] + [rng.randint(0, 30) for _ in range(7)]
        ratios = K.discount(np.arange(1, 40), of)
        assert ((0 < ratios) & (ratios < 1)).all()
