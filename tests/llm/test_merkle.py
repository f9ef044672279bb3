"""Operator 13 against trees built as plain lists."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from weblytics.llm import merkle as M

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, g string, leaf string, idx string, root string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, add=0):
    doc_id, source, lang, n_chars, text = row
    values = [doc_id, source, lang, None if n_chars is None else n_chars + add, text]
    texts = [None if v is None else str(v) for v in values]
    return h("".join("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def path(level, index):
    """Siblings with their side, and the root, of one tree given as its leaves."""
    steps = []
    while len(level) > 1:
        sibling = index ^ 1
        steps.append(None if sibling >= len(level) else (sibling < index, level[sibling]))
        level = [h(*level[i : i + 2]) for i in range(0, len(level), 2)]
        index //= 2
    return steps, level[0]


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    leaves = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        leaves[g] = [leaf_of(r) for r in groups[g]]
    roots = [path(leaves[g], 0)[1] for g in order]
    out = []
    for k, g in enumerate(order):
        for i, row in enumerate(groups[g]):
            steps = path(leaves[g], i)[0] + path(roots, k)[0]
            root = path(roots, 0)[1]
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf_of(row, 1 if tampered else 0)
            for step in steps:
                node = h(node) if step is None else h(step[1], node) if step[0] else h(node, step[1])
            proof = h(*[s[1] for s in steps if s is not None])
            out.append((row[0], leaves[g][i], roots[k], root, proof, node, node == root))
    return out


def documents(spark, rows, partitions=3):
    full = [(r[0], r[4], r[2], r[1], r[3], "x", "y", "z", "w") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def checked(spark, rows, partitions=3, height=M.BLOCK_LEVELS):
    got = M.check_documents(documents(spark, rows, partitions), height)
    assert got.columns == list(COLUMNS)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def hard_rows(n, seed=2):
    rng = random.Random(seed)
    langs = ["en", "de", None, "", "-", "é", "en", "en", "en"]
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "ä" * rng.randint(0, 9), "word " * rng.randint(0, 40)])
        rows.append((i * 3 - 20, rng.choice([None, "web", "a:b"]), rng.choice(langs), rng.choice([None, len(text or "")]), text))
    rows += [rows[3], rows[3], (None, "s", "en", 4, "text"), (None, None, None, None, None), (7, "s", "only", 2, "ab")]
    rows.append((8, "long", "en", 1 << 40, "long " * 50_000))
    return rows


@pytest.mark.parametrize(("n", "height", "partitions"), [(90, 10, 3), (90, 2, 5), (40, 1, 1)])
def test_against_lists(spark, n, height, partitions):
    """Small blocks give several rounds in the groups and over them."""
    rows = hard_rows(n)
    found = checked(spark, rows, partitions, height)
    assert found == sorted(expected(rows), key=repr)
    assert any(r[-1] for r in found) and (n < 90 or not all(r[-1] for r in found))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 9])
def test_one_group_of_few(spark, n):
    rows = [(i, "s", "en", i, f"text {i}") for i in range(n)]
    assert checked(spark, rows) == sorted(expected(rows), key=repr)


def test_empty_table(spark):
    assert checked(spark, []) == []


@pytest.mark.parametrize("levels", range(1, 13))
def test_addresses_are_a_permutation_with_whole_subtrees(levels):
    places = [M.address(d, np.arange(1 << d), levels) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range((1 << levels) - 1))
    if levels > 1:
        top = levels // 2  # the top tree comes first, then each bottom tree as one stretch
        assert np.concatenate(places[:top]).max() == (1 << top) - 2
        size = (1 << (levels - top)) - 1
        for j in range(1 << top):
            under = np.concatenate([places[d][(np.arange(1 << d) >> (d - top)) == j] for d in range(top, levels)])
            assert under.max() - under.min() == size - 1


def test_path_reads_stored_nodes():
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(13)]
    block = M.Block(M.build(leaves, 5), 13, 5)
    for i, leaf in enumerate(leaves):
        steps, root = path([x.hex() for x in leaves], i)
        assert block.node(0, 0).hex() == root == M.fold(leaf, block.path(i)).hex()
        assert [s.hex() for s in M.siblings(block.path(i))] == [s[1] for s in steps if s]
