import random

import pytest

from weblytics.operators.nested_places import flat_ranges, sweep
from weblytics.operators.places import with_places

SCHEMA = "start_ip bigint, end_ip bigint, country string, province string"
BASE = 10 << 24


def text(number):
    return ".".join(str(number >> s & 255) for s in (24, 16, 8, 0))


def owner(number, ranges):
    """The narrowest range, then the later start, then the greater place; nulls least."""
    inside = [r for r in ranges if r[0] <= number <= r[1]]
    key = lambda r: (r[0] - r[1], r[0], [(v is not None, v or "") for v in r[2:]])
    found = max(inside, key=key, default=None)
    return found[2:] if found else (None, None)


def random_ranges(rng, n, span):
    out = []
    for k in range(n):
        first = BASE + rng.randrange(span)
        last = min(first + rng.choice([0, 3, 40, 255, 70_000, 200_000]), BASE + span - 1)
        out.append((first, last, rng.choice(["A", "B", None]), f"p{k % 17}"))
    return out + out[:5]


def test_sweep_against_every_address():
    rng = random.Random(1)
    for _ in range(200):
        ranges = []
        for k in range(rng.randint(1, 9)):
            first = rng.randrange(60)
            ranges.append((first, min(63, first + rng.randint(0, 30)), rng.randint(0, 4) * 10 + k, k))
        want = {}
        for at in range(64):
            inside = [(rank, k) for first, last, rank, k in ranges if first <= at <= last]
            if inside:
                want[at] = min(inside)[1]
        stretches = list(sweep(list(ranges)))
        assert {at: k for first, last, k in stretches for at in range(first, last + 1)} == want
        assert all(a[1] < b[0] for a, b in zip(stretches, stretches[1:]))
        assert all(not (a[1] + 1 == b[0] and a[2] == b[2]) for a, b in zip(stretches, stretches[1:]))


@pytest.mark.parametrize("dense_pieces", [1 << 16, 10])
def test_against_all_ranges(spark, dense_pieces):
    """Nested, across each other, equal, over block borders; in both block widths."""
    rng = random.Random(2)
    span = 5 << 16
    ranges = random_ranges(rng, 250, span)
    probes = {BASE + rng.randrange(span) for _ in range(600)} | {r[0] for r in ranges} | {r[1] for r in ranges}
    probes |= {r[1] + 1 for r in ranges}
    flat = flat_ranges(spark.createDataFrame(ranges, SCHEMA), dense_pieces)
    rows = spark.createDataFrame([(text(p),) for p in probes] + [(None,), ("no address",)], "ip string")
    got = {r["ip"]: (r["country"], r["province"]) for r in with_places(rows, flat).collect()}
    want = {text(p): owner(p, ranges) for p in probes} | {None: (None, None), "no address": (None, None)}
    assert got == want


def test_ranges_without_overlap_stay(spark):
    ranges = [(BASE, BASE + 9, "A", "x"), (BASE + 10, BASE + 19, "B", "y"), (BASE + 50, BASE + 50, None, None)]
    assert sorted(map(tuple, flat_ranges(spark.createDataFrame(ranges, SCHEMA)).collect()), key=repr) == sorted(ranges, key=repr)
    assert flat_ranges(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("bad", [(5, 4), (None, 4), (5, None)])
def test_unusable_ranges_are_refused(spark, bad):
    with pytest.raises(ValueError, match="lack a bound"):
        flat_ranges(spark.createDataFrame([(*bad, "A", "x")], SCHEMA))
