"""Operator 11 against a search over all edit sequences."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from weblytics.llm import conversation_repair as R

SCHEMA = "conv_id bigint, turn bigint, role string, text string, kind string, fault int, _hash string, copies string"
NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]")
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def damage(rows):
    """(turn, role, text) by conversation, in order."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        kept = out.setdefault(conv, [])
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    for rows_of in out.values():
        rows_of.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        found = NOT_SPACE.findall(text)
        if not found:
            out.append(R.BLANK)
        elif (role, text) in seen:
            out.append(R.DUPLICATE)
        elif found[-1] not in ".!?":
            out.append(R.TRUNCATED)
        else:
            out.append(R.SOUND)
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Every sequence of edits of a short conversation, inserts at most two in a row."""
    best = None
    choices = []
    for (_, role, text), fault in zip(rows, found):
        options = [("D", 4, None)]
        if fault not in (R.BLANK, R.DUPLICATE):
            more = 3 if fault == R.TRUNCATED else 0
            options += [("K", more, (role, text)), ("R", 3 + more, ("user", text)), ("R", 3 + more, ("assistant", text))]
        choices.append(options)
    gaps = [("", 0, ())] + [("I", 3, (x,)) for x in ("user", "assistant")]
    gaps += [("II", 6, pair) for pair in itertools.product(("user", "assistant"), repeat=2)]
    for edits in itertools.product(*choices):
        for inserts in itertools.product(gaps, repeat=len(rows) + 1):
            cost = sum(e[1] for e in edits) + sum(g[1] for g in inserts)
            if best is not None and cost > best[0]:
                continue
            audit, out = "", []
            for k, gap in enumerate(inserts):
                audit += gap[0]
                out += [(role, "") for role in gap[2]]
                if k < len(edits):
                    audit += edits[k][0]
                    out += [edits[k][2]] if edits[k][2] else []
            if LEGAL.match("".join(role[:1] or "?" for role, _ in out)):
                kept = "\n".join(f"{role}:{text}" for role, text in out)
                best = min(best, (cost, audit, kept)) if best else (cost, audit, kept)
    return best


def by_states(rows, found):
    """Cost and audit with whole texts kept for each state: the plain form for long conversations."""
    held = {R.START: (0, "")}
    for (_, role, _), fault in zip(rows, found):
        new = {}
        initial = role[:1] if role[:1] in ("s", "u", "a") else ""
        for s, t, c, e in R.MOVES[initial, fault in (R.BLANK, R.DUPLICATE), fault == R.TRUNCATED]:
            if s in held:
                option = (held[s][0] + c, held[s][1] + e)
                new[t] = min(new.get(t, option), option)
        held = new
    return min((held[s][0] + c, held[s][1] + e) for s, c, e in R.ENDS if s in held)


def searched(rows, found):
    edits = []
    search = R.Search(edits.append)
    open_most = 0
    for (_, role, _), fault in zip(rows, found):
        search.row(role[:1], fault in (R.BLANK, R.DUPLICATE), fault == R.TRUNCATED)
        open_most = max(open_most, sum(len(n.edits) for _, leaf in search.survivors.values() for n in R._line(leaf)))
        assert max(len(R._line(leaf)) for _, leaf in search.survivors.values()) <= 5
    cost = search.end()
    return (cost, "".join(edits)), open_most


def random_rows(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", " ", "", "usr"]
    texts = ["Yes.", "No", "Why?", "", " \t", "So!", "and ", "One. \n"]
    return [(k, rng.choice(roles), f"{rng.choice(texts)}" if rng.random() < 0.5 else f"{k}{rng.choice(texts)}") for k in range(n)]


def test_search_against_all_sequences():
    rng = random.Random(5)
    for n in (0, 1, 2, 3):
        for _ in range(40 if n < 3 else 8):
            rows = random_rows(rng, n)
            found = faults(rows)
            assert searched(rows, found)[0] == cheapest(rows, found)[:2]
            assert by_states(rows, found) == cheapest(rows, found)[:2]


def test_search_against_whole_texts():
    rng = random.Random(6)
    for _ in range(300):
        rows = random_rows(rng, rng.randint(4, 60))
        found = faults(rows)
        assert searched(rows, found)[0] == by_states(rows, found)


def test_agreed_edits_are_forgotten_and_long_ties_are_held():
    sound = [(k, "user" if k % 2 == 0 else "assistant", f"{k}.") for k in range(20_000)]
    (cost, audit), held = searched(sound, [R.SOUND] * len(sound))
    assert cost == 0 and audit == "K" * 20_000 and held < 20
    one_role = [(k, "user", f"{k}.") for k in range(4_000)]
    (cost, audit), held = searched(one_role, [R.SOUND] * len(one_role))
    assert (cost, audit) == by_states(one_role, [R.SOUND] * len(one_role)) and held > 2_000


def test_pending_rows_wait_in_a_file():
    pending = R.Pending(limit=200)
    rows = [("user", str(k) * 30) for k in range(50)]
    taken = []
    for k, row in enumerate(rows):
        pending.put(row)
        if k % 3 == 2:
            taken.append(pending.take())
    while len(taken) < len(rows):
        taken.append(pending.take())
    assert taken == rows


def hard_rows():
    rng = random.Random(9)
    rows = [(conv, turn, role, text) for conv in range(60) for turn, role, text in random_rows(rng, rng.randint(1, 4))]
    rows += [(None, 1, "user", "No id."), (None, None, None, None), (70, None, "user", "A."), (70, None, "assistant", None)]
    rows += [(71, 5, "user", "Same."), (71, 5, "user", "Same."), (71, 9, "assistant", "x. " * 4000), (72, -3, None, "B!")]
    rows += [(73, k, "user", f"All of one role {k}.") for k in range(3)]
    return rows


def frame(spark, rows, partitions=3):
    full = [(*r, "x", 9, "h", "c") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 7])
def test_report(spark, partitions):
    rows = hard_rows()
    damaged = R.damaged(frame(spark, rows, partitions))
    got = {r["conv_id"]: r for r in R.report(damaged).collect()}
    expected = damage(rows)
    assert got.keys() == expected.keys()
    for conv, after in expected.items():
        found = faults(after)
        cost, audit, kept = cheapest(after, found) if len(after) <= 3 else (*by_states(after, found), None)
        row = got[conv]
        turns = {t for t, _, _ in after if t is not None}
        initials = [role[:1] for _, role, _ in after]
        assert row["gaps"] == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)
        assert [row[c] for c in ("blank", "duplicate", "truncated")] == [found.count(f) for f in (1, 2, 3)]
        assert row["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        assert (row["cost"], row["audit"]) == (cost, audit)
        if kept is not None:
            assert row["repaired_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    empty = [r for c, r in got.items() if not expected[c]]
    assert empty and all(r["audit"] == "" and r["cost"] == 0 for r in empty)


def test_edits_give_the_reported_hash(spark):
    damaged = R.damaged(frame(spark, hard_rows()))
    edits = {}
    for r in R.repair(damaged).orderBy("conv_id", "place").collect():
        edits.setdefault(r["conv_id"], []).append(r)
    for r in R.report(damaged).collect():
        of = edits.get(r["conv_id"], [])
        assert "".join(e["edit"] for e in of) == r["audit"]
        kept = [(e["role"], e["text"]) for e in of if e["edit"] != "D"]
        assert LEGAL.match("".join(role[:1] for role, _ in kept))
        text = "\n".join(f"{role}:{t}" for role, t in kept)
        assert hashlib.sha256(text.encode()).hexdigest() == r["repaired_sha256"]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert R.report(R.damaged(none)).count() == 0 and R.repair(R.damaged(none)).count() == 0
