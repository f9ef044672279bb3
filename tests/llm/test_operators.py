"""Each operator against a brute-force version, on a table with the hard cases."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import components, hard_rows, lower, removed_bytes, simhash, table
from weblytics.llm import (
    exact_dedup, fingerprints, lang_id, line_dedup, loser_tree, packing, pieces, quality_crf, sharding, simhash_ball, suffix_dedup,
)

BIG = (1 << 63) - 1


@pytest.fixture(scope="module")
def rows():
    return hard_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [(1, "a")]).where("doc_id < 0")


def bag(values):
    return Counter(values)


def test_sharding(docs, rows):
    found = sharding.shard_documents(docs, 8, 42).collect()
    want = bag((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert bag((r.doc_id, r["size"], r.text_crc32) for r in found) == want
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    sizes = [len(by_shard[k]) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1


def test_sharding_follows_the_permutation(spark, rows):
    """Distinct rows have one order each, so each row's place is known."""
    distinct = list({(i, (t or "").encode()): (i, t) for i, t in rows}.values())
    found = sharding.shard_documents(table(spark, distinct), 8, 42).collect()
    n = len(distinct)
    order = sorted(found, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text_crc32, r["size"]))
    places = sharding.permute(np.arange(n), n, 42)
    assert [(p % 8, p // 8) for p in places.tolist()] == [(r.shard, r.slot) for r in order]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 65, 1000, 4097])
def test_permutation(n):
    places = sharding.permute(np.arange(n), n, 7)
    assert sorted(places.tolist()) == list(range(n))
    assert sharding.invert(places, n, 7).tolist() == list(range(n))
    if n > 60:
        assert places.tolist() != sharding.permute(np.arange(n), n, 8).tolist()


def test_suffix_dedup(spark, docs, rows, monkeypatch):
    want = removed_bytes(rows)

    def compare():
        found = suffix_dedup.remove_repeats(docs).collect()
        got = bag((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found)
        expect = []
        for i, t in rows:
            raw, gone = (t or "").encode(), want[(i, t)]
            runs = sum(g and not before for g, before in zip(gone, [False, *gone]))
            expect.append((i, len(raw), sum(gone), runs, bytes(b for b, g in zip(raw, gone) if not g)))
        assert got == bag(expect)

    compare()
    monkeypatch.setattr(suffix_dedup, "MANY", 2)  # common classes go as single windows
    compare()


def test_suffix_buckets_are_even():
    """Anchors have small hashes, their buckets are alike all the same."""
    raw = np.random.default_rng(2).integers(97, 123, 1 << 18).astype(np.uint8)
    hashes = np.unique(suffix_dedup.anchors(raw, np.array([len(raw)]), 50)[3])
    sizes = np.bincount(suffix_dedup._buckets(hashes, 16), minlength=16)
    assert len(sizes) == 16 and sizes.max() < 1.3 * sizes.mean() and sizes.min() > 0.7 * sizes.mean()


@pytest.mark.parametrize("span", [16, 33, 50, 77])
def test_suffix_spans(spark, span):
    rows = [(k, ("abcab" * 7)[k % 5 :] + "q" * (k % 4) + "xyzzy" * 9 + str(k % 3)) for k in range(25)]
    want = removed_bytes(rows, span)
    found = suffix_dedup.remove_repeats(table(spark, rows), span).collect()
    assert {r.doc_id: r.n_removed for r in found} == {i: sum(want[(i, t)]) for i, t in rows}


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_near_groups(docs, rows, bits):
    prints = {(BIG if i is None else i, t): simhash(t) for i, t in rows}
    nodes = {}
    for (i, _), p in prints.items():
        nodes[p] = min(nodes.get(p, BIG), i)
    label = components({(i, p): p for p, i in nodes.items()}, bits)
    want = Counter()
    for i, t in rows:
        p = simhash(t)
        least = label[(nodes[p], p)][0]
        want[(i, f"{p:016x}", None if least == BIG else least)] += 1
    found = simhash_ball.near_groups(docs, 3, bits).collect()
    assert bag((r.doc_id, r.fingerprint, r.component_id) for r in found) == want


def test_balls_lose_no_link(spark):
    """Random clouds of fingerprints at every distance, chains included."""
    rng = np.random.default_rng(5)
    prints = {}
    for k in range(40):
        at = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for step in range(8):
            prints[100 * k + step] = at
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                at ^= 1 << int(b)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    known = spark.createDataFrame([(signed(p), i) for i, p in prints.items()], "fp bigint, id bigint")
    links = simhash_ball.ball_links(known, 3).collect()
    close = {r.fp for r in simhash_ball._with_neighbours(known.select("fp"), 3).collect()}
    label = {p: p for p in prints.values()}
    for _ in range(20):
        for r in links:
            a, b = r.a % (1 << 64), r.b % (1 << 64)
            label[a] = label[b] = min(label[a], label[b])
    ids = list(prints)
    want = components({p: p for p in prints.values()}, 3)
    assert all((label[prints[a]] == label[prints[b]]) == (want[prints[a]] == want[prints[b]]) for a in ids for b in ids)
    assert all(signed(a) in close for a in prints.values() for b in prints.values() if a != b and (a ^ b).bit_count() <= 3)


def test_long_chain(spark):
    from weblytics.llm.components import smallest_labels

    nodes = spark.createDataFrame([(i, 1000 - i) for i in range(200)] + [(500, 1)], "node bigint, rank bigint")
    links = spark.createDataFrame([(i, i + 1) for i in range(199)], "a bigint, b bigint")
    found = {r.node: r.label.rank for r in smallest_labels(nodes, links).collect()}
    assert found == {**{i: 801 for i in range(200)}, 500: 1}


@pytest.mark.parametrize("least", [2, 3])
def test_line_dedup(docs, rows, least):
    white = " \t\n\x0b\x0c\r"
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(white))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(BIG if i is None else i)
    want = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(holders[key(x)]) < least or min(holders[key(x)]) == (BIG if i is None else i)]
        want.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    found = line_dedup.drop_shared_lines(docs, min_documents=least).collect()
    assert bag((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found) == bag(want)


def test_line_dedup_is_native(docs, plan):
    text = plan(line_dedup.drop_shared_lines(docs)) + plan(fingerprints.fingerprint_documents(docs))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_exact_groups(docs, rows, monkeypatch):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    found = exact_dedup.exact_groups(docs).collect()
    want = Counter()
    for content, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            want[(i, max(known, default=None), len(ids), hashlib.sha256(content).hexdigest())] += 1
    assert bag((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == want
    kept = [r for r in found if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_grace_recursion():
    """Buckets far smaller than the data, and equal hashes of different contents."""
    records = [(k, (k % 50) * 0x123456789ABCDEF % (1 << 64), 1, k, k, b"%d" % (k % 50) * 50) for k in range(400)]
    records += [(400 + k, 7, 1, k, k, b"same hash %d" % (k % 3)) for k in range(30)]
    answers = {a[0]: a for a in exact_dedup.grace(iter(records), bucket_bytes=500)}
    assert len(answers) == 430
    assert {a[3] for k, a in answers.items() if k < 400} == {8} and {a[3] for k, a in answers.items() if k >= 400} == {10}
    assert answers[3][1] == 353


def test_hot_contents_merge_in_groups(spark):
    """Contents that most tasks hold, some without an id: the same answers by way of salted groups."""
    rows = [(None if k % 7 == 0 else k, ("Hot " if k % 2 else "hot ") * 50) for k in range(60)]
    rows += [(k, "warm " * 30) for k in range(60, 90)] + [(None, "no id " * 40)] * 20 + [(k, f"cold {k}") for k in range(90, 130)]
    docs = table(spark, rows, partitions=12)
    written = exact_dedup.texts(docs).mapInArrow(exact_dedup.collapse, exact_dedup.COLLAPSED).where("content IS NOT NULL")
    hot = exact_dedup.hot_hashes(written, least_bytes=300).collect()
    assert len(hot) == 3 and all(r.salts > 1 for r in hot)
    members = defaultdict(list)
    for i, t in rows:
        members[lower(t)].append(i)
    for found in (exact_dedup.exact_groups(docs, hot_bytes=300), exact_dedup.exact_groups(docs)):
        found = found.collect()
        assert sorted(repr(r.doc_id) for r in found) == sorted(repr(i) for i, _ in rows)
        by_digest = defaultdict(list)
        for r in found:
            by_digest[r.text_sha256].append(r)
        assert set(by_digest) == {hashlib.sha256(t).hexdigest() for t in members}
        for text, ids in members.items():
            group = by_digest[hashlib.sha256(text).hexdigest()]
            keep = max((i for i in ids if i is not None), default=None)
            assert {(r.group_size, r.keep_id) for r in group} == {(len(ids), keep)}
            assert [r.doc_id for r in group if r.kept] == [keep]


def test_merged_groups_beyond_the_table(monkeypatch):
    """A table emptied between repeats gives a content again under another number; sizes add up."""
    monkeypatch.setattr(exact_dedup, "BUCKET_BYTES", 700)
    columns = ["class", "hash", "content", "n", "best", "best_row"]
    records = [(k, k % 3, bytes([97 + k % 3]) * 300, k + 1, k, k) for k in range(30)]
    batch = exact_dedup.pa.RecordBatch.from_pydict(dict(zip(columns, map(list, zip(*records)))))
    out = [r for b in exact_dedup.merge_partition(iter([batch])) for r in b.to_pylist()]
    into = {r["member"]: r["class"] for r in out if r["member"] is not None}
    merged = [r for r in out if r["content"] is not None]
    assert set(into) == set(range(30)) and set(into.values()) == {r["class"] for r in merged}
    assert len(merged) > 3 and len({r["class"] for r in merged}) == len(merged)
    for r in merged:
        mine = [k for k, c in into.items() if c == r["class"]]
        assert r["class"] in mine and {k % 3 for k in mine} == {r["content"][0] - 97} == {r["hash"]}
        assert (r["n"], r["best"], r["best_row"]) == (sum(k + 1 for k in mine), max(mine), max(mine))


def test_fingerprints(spark, docs, rows):
    found = fingerprints.fingerprint_documents(docs).collect()
    assert len(found) == len(rows)
    unique = {i: t for i, t in rows if i is not None}
    order = sorted(unique)
    plain = table(spark, [(i, unique[i]) for i in order])
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(plain).collect()}
    prints = {}
    for k, i in enumerate(order):
        text, after = unique[i] or "", unique[order[(k + 1) % len(order)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].next_fp == got[order[(k + 1) % len(order)]].fp
        prints.setdefault(text, set()).add(got[i].fp)
    assert all(len(p) == 1 for p in prints.values())
    alone = fingerprints.fingerprint_documents(table(spark, [(4, "one two three")])).collect()
    assert alone[0].fp == alone[0].next_fp


def test_votes_by_hand(spark):
    text = "a b a b c"
    hashes = spark.sql("select xxhash64('a','b') ab, xxhash64('b','a') ba, xxhash64('b','c') bc, xxhash64('c') c").first()
    terms = [hashes.ab % (1 << 64)] * 2 + [hashes[k] % (1 << 64) for k in ("ba", "bc", "c")]
    want = sum(1 << b for b in range(64) if 2 * sum(t >> b & 1 for t in terms) > len(terms))
    found = fingerprints.fingerprint_documents(table(spark, [(1, text)])).first()
    assert found.fp % (1 << 64) == want


@pytest.mark.parametrize("radius", [0, 2, 3])
def test_block_tables(spark, radius):
    rng = np.random.default_rng(radius)
    values = set()
    for _ in range(60):
        at = int(rng.integers(-(1 << 63), 1 << 63))
        for _ in range(4):
            values.add(at)
            for b in rng.choice(63, 2, replace=False):
                at ^= 1 << int(b)
    known = spark.createDataFrame([(v,) for v in values], "fp bigint")
    asked = known.where(F.col("fp") % 3 == 0)
    found = {(r.q, r.fp) for r in fingerprints.near_fingerprints(asked, known, radius).collect()}
    want = {(a.fp, b) for a in asked.collect() for b in values if ((a.fp ^ b) % (1 << 64)).bit_count() <= radius}
    assert found == want


def test_languages(spark):
    import random

    rng = random.Random(1)
    vocab = {"aa": ["katze", "hund", "strasse", "bruecke"], "bb": ["gatto", "cane", "strada", "ponte"]}
    rows = []
    for k in range(80):
        lang = "aa" if k % 2 else "bb"
        rows.append((k, " ".join(rng.choice(vocab[lang]) for _ in range(30)), lang))
    rows += [(900, None, "aa"), (901, "", "aa"), (902, "12 34 !", "bb"), (None, "gatto cane ponte strada gatto", None), (5, rows[5][1], "aa")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = lang_id.predict_languages(frame, lang_id.learn(frame)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[k].lang_pred == ("aa" if k % 2 else "bb") for k in range(80))
    assert all(by_id[k].lang_pred == "und" and by_id[k].rejected and by_id[k].margin == 0 for k in (900, 901, 902))
    assert by_id[None].lang_pred == "bb" and all(0 <= r.margin <= 1 for r in found)
    assert all(r.rejected for r in lang_id.predict_languages(frame, {}).collect())


def test_languages_by_recomputed_sizes(spark):
    """Sizes, margin and rejection from single calls of the compressor, for every row by itself."""
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learned = lang_id.learn(docs)
    kinds = {lang: zstandard.ZstdCompressionDict(v.dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for lang, v in learned.items()}

    def size(lang, data):
        return len(zstandard.ZstdCompressor(
            dict_data=kinds[lang], level=lang_id.LEVEL, write_content_size=False, write_dict_id=False).compress(data))

    def ranked(sizes):
        (best, lang), (second, _) = sorted((n, lang) for lang, n in sizes.items())[:2]
        return lang, 1 - max(1, best) / max(1, best, second)

    def expected(text):
        if not text or not any(c.isalpha() for c in text):
            return "und", 0.0
        plain = lang_id.letters(text)
        blocks = [plain[i : i + lang_id.BLOCK] for i in range(0, len(plain), lang_id.BLOCK)]
        found = ranked({lang: sum(size(lang, b) - lang_id.FRAME for b in blocks) for lang in learned})
        if len(plain) >= lang_id.SHORT and found[1] >= lang_id.NARROW:
            return found
        return ranked({lang: sum(size(lang, c + b) - size(lang, c) for c in learned[lang].contexts for b in blocks) for lang in learned})

    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in lang_id.predict_languages(docs, learned).collect():
        lang, margin = expected(texts[r.doc_id])
        assert (r.lang_pred, r.rejected) == (lang, lang == "und" or margin < lang_id.NARROW)
        assert r.margin == pytest.approx(margin)


def test_language_samples_share_alike(spark):
    """Repeated ids and texts count once, a very long text is one of many, and a language may be a few bytes."""
    long = " ".join(f"lang{k}wort" for k in range(200_000))
    rows = [(10, long, "aa"), *[(10, f"gleich {k}", "aa") for k in range(300)], *[(k, "immer derselbe Text", "aa") for k in range(50, 90)]]
    rows += [(k, f"kurz und eigen nummer {chr(97 + k % 26)}{chr(97 + k // 26)}", "aa") for k in range(100, 300)]
    rows += [(400, "é", "bb"), (401, "xyz", "bb")]
    learned = lang_id.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    aa = learned["aa"].dictionary + b"".join(learned["aa"].contexts)
    assert aa.count(b"lang") < 100 and aa.count(b"immer derselbe") < 30 and aa.count(b"kurz und eigen") > 100
    assert len(learned["aa"].dictionary) <= lang_id.DICTIONARY_BYTES and len(learned["bb"].dictionary) >= 8
    found = lang_id.Classifier(learned)
    assert found.predict("é")[0] in ("aa", "bb") and found.predict("kurz und eigen nummer")[0] == "aa"


def test_marginals_by_enumeration():
    from itertools import product

    rng = np.random.default_rng(0)
    emission, moves = rng.normal(size=6), rng.normal(size=(2, 2))
    weights = {}
    for path in product((0, 1), repeat=6):
        weights[path] = np.exp(sum(e for e, s in zip(emission, path) if s) + sum(moves[a, b] for a, b in zip(path, path[1:])))
    total = sum(weights.values())
    want = [sum(w for p, w in weights.items() if p[k]) / total for k in range(6)]
    assert np.allclose(quality_crf.good_chances(emission, moves), want)


def test_score_weighs_marginals_by_length():
    """The score from chances found by enumeration and lengths counted here."""
    from itertools import product

    rng = np.random.default_rng(3)
    field = quality_crf.Field(
        rng.normal(size=quality_crf.WIDTH), np.ones(quality_crf.WIDTH), rng.normal(size=quality_crf.WIDTH) / 9, rng.normal(size=(2, 2))
    )
    text = "First line here.\n\nSECOND | line 12\nlast one, much longer than all of the others before it"
    lines = text.encode().split(b"\n")
    emission = field.emission(quality_crf.line_features(text.encode())[0])
    weights = {}
    for path in product((0, 1), repeat=len(lines)):
        total = sum(e for e, s in zip(emission, path) if s) + sum(field.transition[a, b] for a, b in zip(path, path[1:]))
        weights[path] = np.exp(total)
    chances = [sum(w for p, w in weights.items() if p[k]) / sum(weights.values()) for k in range(len(lines))]
    lengths = [len(x) + 1 for x in lines]
    want = sum(c * n for c, n in zip(chances, lengths)) / sum(lengths)
    assert field.score(text.encode()) == pytest.approx(want)


def test_quality_training_is_bounded(spark, monkeypatch):
    """One row and one label for each id, and lines from anywhere in a long text."""
    docs = [(1, f"copy {k} of one id") for k in range(300)] + [(k, f"text {k}\nnext") for k in range(2, 40)] + [(None, "x"), (2, None)]
    labels = [(k, k % 2, 0) for k in range(1, 40)] + [(1, 0, 0), (None, 1, 0), (3, None, 0)]
    seen = []
    monkeypatch.setattr(quality_crf, "fit", lambda documents: seen.append(documents))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    quality_crf.learn(frame, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), 12)
    assert len(seen[0]) <= 12
    features = np.arange(1000.0)[:, None] * np.ones((1, quality_crf.WIDTH))
    starts = set()
    for i in range(60):
        chosen = quality_crf.training_lines(i, features)[:, 0]
        assert len(chosen) == quality_crf.TRAIN_LINES and (np.diff(chosen) == 1).all()
        starts.add(int(chosen[0]))
    assert len(starts) > 40 and max(starts) > 600
    assert len(quality_crf.training_lines(1, features[:200])) == 200


def test_near_counts_against_all_rows(spark):
    """Rows within the radius of each query row, itself included; no count for other rows."""
    rng = np.random.default_rng(5)
    prints = []
    for k in range(120):
        base = prints[k // 2][1] if k % 3 and prints else int(rng.integers(-(1 << 63), (1 << 63) - 1))
        for bit in rng.integers(0, 63, k % 5):
            base ^= 1 << int(bit)
        prints.append((k if k % 10 else None, base))
    prints += prints[:7]
    frame = spark.createDataFrame(prints, "doc_id bigint, fp bigint")
    found = fingerprints.with_near_counts(frame, F.col("doc_id") % 4 == 0).collect()
    bits = lambda a, b: ((a ^ b) % (1 << 64)).bit_count()
    want = bag((i, f, sum(bits(f, g) <= 3 for _, g in prints) if i is not None and i % 4 == 0 else None) for i, f in prints)
    assert bag((r.doc_id, r.fp, r.near_documents) for r in found) == want


def test_quality_learns(spark):
    import random

    rng = random.Random(2)
    good = lambda: " ".join(rng.choice("one two three four five six".split()) for _ in range(12)) + "."
    bad = lambda: " ".join(rng.choice("BUY$$ NOW### WIN%%".split()) for _ in range(12))
    rows = [(k, "\n".join((good if k % 2 else bad)() for _ in range(1 + k % 5))) for k in range(120)]
    rows += [(500, None), (501, ""), (None, good()), (3, rows[3][1])]
    frame = table(spark, rows)
    labels = spark.createDataFrame([(k, k % 2) for k in range(120)] + [(500, None), (None, 1)], "doc_id bigint, quality int")
    field = quality_crf.learn(frame, labels)
    found = quality_crf.score_documents(frame, field).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found if r.doc_id is not None)
    assert all(r.predicted == r.doc_id % 2 for r in held if r.doc_id < 120)
    flat = quality_crf.learn(frame, labels.where("false"))
    assert {r.score for r in quality_crf.score_documents(frame, flat).collect()} == {0.5}


def test_pieces_round_trip(docs, rows):
    found = pieces.encode_documents(docs).collect()
    assert len(found) == len(rows) and all(r.round_trip for r in found)
    back = pieces.decode_documents(pieces.encode_documents(docs)).collect()
    assert bag((r.doc_id, r.text) for r in back) == bag((i, t or "") for i, t in rows)


def test_pieces_best_score():
    """The Viterbi sum equals that of all segmentations."""
    vocabulary = [("", 0.0)] * 256 + [("▁", -3.0), ("a", -2.0), ("b", -2.5), ("ab", -3.5), ("▁a", -4.0), ("ba", -3.0), ("aba", -6.5), ("bab", -4.4)]
    coder = pieces.PieceCoder(vocabulary, list(range(256)))
    scores = dict(v for v in vocabulary if v[0])

    def best(text):
        table = [0.0] + [float("-inf")] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(end):
                piece = text[start:end]
                score = scores.get(piece, coder.fallback if len(piece) == 1 else float("-inf"))
                table[end] = max(table[end], table[start] + score)
        return table[-1]

    for text in ("▁abab", "▁ababab", "▁ba▁ab", "▁xaby", "bababab", "▁▁a"):
        ids = coder.best_path(text)
        total = sum(vocabulary[i][1] if i >= 256 else coder.fallback for i in ids)
        assert abs(total - best(text)) < 1e-9


def test_packing(spark, docs, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    found = packing.pack(docs, with_ids=True).collect()
    assert sorted(r.sequence_id for r in found) == list(range(len(found)))
    assert all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 4096 for r in found)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in found)
    unique = {i: t for i, t in rows if i is not None and rows.count((i, t)) == 1}
    for i, t in unique.items():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        mine = sorted((r for r in found if r.doc_id == i), key=lambda r: r.start)
        assert [x for r in mine for x in r.ids] == ids
        assert all(r.doc_tokens == len(ids) for r in mine)
    lengths = [r.length for r in sorted(found, key=lambda r: r.sequence_id)]
    assert lengths == sorted(lengths)


def test_cached_words(monkeypatch):
    """Random texts, with a cache that turns over and without, against the tokenizer itself."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    rng = np.random.default_rng(3)
    signs = np.array(list("aAéÉßİΣσςñ'sStT$&.,_<|>-0९́×Kǅ\u3000\xa0中é\t\r\nfi\u200d" + " " * 12))
    texts = ["".join(rng.choice(signs, rng.integers(0, 60))) for _ in range(400)]
    texts += ["don't 'S abc<|endoftext|>x Straße$$$ STRASSE&&& ", "", " ", "Ab" * 300 + "... ab", "ΣΑΣ. Σ"]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for size in (10, packing.CACHED_WORDS):
        monkeypatch.setattr(packing, "CACHED_WORDS", size)
        words = packing.WordTokenizer(packing.tokenizer_path())
        assert [words.encode(t) for t in texts + texts] == want + want
        assert len(words.known) <= 2 * size + 100 and max(map(len, words.known)) <= packing.LONGEST_CACHED


def test_binary_lengths():
    for n in (1, 2, 4095, 4096, 4097, 100_003):
        parts = packing.binary_lengths(n)
        assert sum(parts) == n and parts == sorted(parts, reverse=True)


def test_loser_tree():
    rng = np.random.default_rng(1)
    for count in (1, 2, 3, 7):
        runs = []
        for k in range(count):
            rows = rng.integers(0, 3, size=(k * 5 if k else 4, 12)).astype(np.uint8)
            rows = rows[np.lexsort(rows.T[::-1])]
            shared, tails = loser_tree.front_code(rows)
            assert (loser_tree.front_decode(shared, tails, 12) == rows).all()
            runs.append((rows, shared))
        order, shared = loser_tree.merge_runs(runs)
        merged = np.concatenate([r[0] for r in runs])[order]
        assert [bytes(r) for r in merged] == sorted(bytes(r) for r in merged)
        assert (shared == loser_tree.common_prefixes(merged)).all()


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert sharding.shard_documents(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert simhash_ball.near_groups(empty).count() == 0
    assert line_dedup.drop_shared_lines(empty).count() == 0
    assert quality_crf.score_documents(empty, quality_crf.learn(empty, labels)).count() == 0
    assert pieces.encode_documents(empty).count() == 0
    assert exact_dedup.exact_groups(empty).count() == 0
    prints = fingerprints.signatures(empty)
    assert fingerprints.with_near_counts(prints, F.col("doc_id") % 100 == 0).count() == 0
    assert lang_id.predict_languages(empty, lang_id.learn(empty)).count() == 0
    assert packing.pack(empty).count() == 0
