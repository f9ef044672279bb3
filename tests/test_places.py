"""IP ranges: both routes against a brute-force search, skew, and unusable tables."""

import functools
import random

import pytest
from pyspark.sql import functions as F

from weblytics.operators import lookup
from weblytics.operators.lookup import by_distinct_key
from weblytics.operators.places import range_pieces, with_places
from weblytics.plans import etl
from weblytics.plans.fixtures import ip_ranges, log_lines

RANGES = "start_ip long, end_ip long, country string, province string"


def text_of(number):
    return ".".join(str(number >> s & 255) for s in (24, 16, 8, 0))


@pytest.fixture(scope="module")
def table():
    """Ranges of very different width, some of them touching, with gaps."""
    rng = random.Random(7)
    rows, at = [], 0
    for i in range(300):
        at += rng.choice([0, 0, 1, 5, 70_000])
        width = rng.choice([1, 2, 256, 65_536, 200_000, 9_000_000])
        rows.append((at, at + width - 1, f"c{i % 7}", f"p{i}"))
        at += width
    return rows


@pytest.fixture(scope="module")
def hits(table):
    rng = random.Random(11)
    numbers = [n for start, end, _, _ in table for n in (start, end, end + 1, max(start - 1, 0))]
    numbers += [rng.randrange(table[-1][1] + 1000) for _ in range(300)]
    ips = [text_of(n) for n in numbers]
    ips += [text_of(table[5][0])] * (len(ips) // 2)  # a third of all rows
    ips += [None, "300.1.1.1", "300.1.1.1", "1.2.3"]
    return [(ip, i) for i, ip in enumerate(ips)]


def brute(hits, table):
    expected = {}
    for ip, i in hits:
        place = (None, None)
        octets = [int(o) for o in ip.split(".")] if ip else []
        if len(octets) == 4 and max(octets) < 256:
            number = sum(o << s for o, s in zip(octets, (24, 16, 8, 0)))
            place = next(((c, p) for s, e, c, p in table if s <= number <= e), place)
        expected[i] = place
    return expected


def placed(df):
    rows = df.collect()
    found = {r["i"]: (r["country"], r["province"]) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize(
    "limits",
    [{}, {"broadcast_bytes": 0}, {"widest_block": 0}, {"widest_block": 2}],
    ids=["broadcast", "as-of", "all-dense", "mixed"],
)
def test_places_against_brute_force(spark, table, hits, limits):
    df = spark.createDataFrame(hits, "ip string, i int")
    found = with_places(df, spark.createDataFrame(table, RANGES), **limits)
    assert found.columns == ["ip", "i", "country", "province"]
    assert placed(found) == brute(hits, table)


def test_small_table_is_an_equi_join(spark, table, hits, plan):
    df = spark.createDataFrame(hits, "ip string, i int")
    text = plan(with_places(df, spark.createDataFrame(table, RANGES)))
    assert "BroadcastHashJoin" in text
    assert "NestedLoop" not in text
    assert "CartesianProduct" not in text


def test_pieces_of_a_range(spark):
    ranges = spark.createDataFrame([(65_530, 131_080, "c", "p")], RANGES)
    pieces = [tuple(r)[:3] for r in range_pieces(ranges).collect()]
    assert pieces == [(0, 65_530, 65_535), (1, 65_536, 131_071), (2, 131_072, 131_080)]


@pytest.mark.parametrize(
    "rows",
    [
        [(1, 10, "a", "a"), (10, 20, "b", "b")],
        [(1, 70_000, "a", "a"), (66_000, 66_001, "b", "b")],
        [(10, 1, "a", "a")],
        [(None, 1, "a", "a")],
    ],
)
def test_unusable_ranges_are_refused(spark, rows):
    df = spark.createDataFrame([("1.2.3.4",)], "ip string")
    with pytest.raises(ValueError, match="range"):
        with_places(df, spark.createDataFrame(rows, RANGES))


def test_empty_range_table(spark):
    df = spark.createDataFrame([("1.2.3.4",)], "ip string")
    row = with_places(df, spark.createDataFrame([], RANGES)).first()
    assert (row["country"], row["province"]) == (None, None)


def test_keyed_rows_by_the_large_table_route(spark, sf_dir, monkeypatch):
    lines, ranges = log_lines(spark, sf_dir), ip_ranges(spark, sf_dir)
    expected = etl.keyed_rows(lines, ranges)
    written = []
    monkeypatch.setattr(lookup, "_written", lambda df, name, do=lookup._written: (
        written.append(name), do(df, name))[1])
    monkeypatch.setattr(etl, "with_places", functools.partial(with_places, broadcast_bytes=0))
    found = etl.keyed_rows(lines, ranges)
    assert written == ["rows", "lookup"]
    assert found.columns == expected.columns
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_lookup_keeps_every_row_under_skew(spark, monkeypatch, plan):
    monkeypatch.setattr(lookup, "HOT_SHARE", 10)
    df = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50))
        .alias("key"),
    )
    joined = by_distinct_key(
        df, "key", lambda keys: keys.withColumn("value", F.upper("key")), broadcast_bytes=0
    )
    text = plan(joined)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" in text
    wrong = joined.where(~F.col("value").eqNullSafe(F.upper("key")))
    assert joined.count() == 3000
    assert joined.select("id").distinct().count() == 3000
    assert wrong.isEmpty()
