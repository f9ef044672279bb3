"""Row keys, upsert, cells."""

import random
import zlib
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from weblytics.functions.text import info_hash, joined_text, row_key
from weblytics.operators.cells import first_rows, sorted_cells, to_cells
from weblytics.operators.parse import parse_lines, with_row_key
from weblytics.operators.upsert import in_key_ranges, latest_hits
from weblytics.plans.etl import all_hits, keyed_rows
from weblytics.schema import PLACE_COLUMNS, STORED_COLUMNS

URL, IP, REFER = "GET /robots.txt HTTP/1.1", "66.249.75.159", "http://www.google.com/bot.html"
DAY = "20240101"


def line(second=0, ip="1.1.1.1", url="/a", refer="-", agent="curl/8.0", sent="1"):
    at = (datetime(2024, 1, 1) + timedelta(seconds=second)).strftime("%d/%b/%Y:%H:%M:%S")
    return f'{ip} - - [{at} +0000] "GET {url} HTTP/1.1" 200 {sent} "{refer}" "{agent}"'


def lines_of(spark, *texts, day=DAY):
    return spark.createDataFrame([(day, t) for t in texts], "day string, line string")


@pytest.mark.parametrize(
    ("info", "key"),
    [
        (REFER + URL + IP, "20200106_2372412137"),
        (URL + REFER + IP, "20200106_312541380"),
        ("", "20200106_0"),
        (None, "20200106_0"),
        ("héllo", f"20200106_{zlib.crc32('héllo'.encode())}"),
    ],
)
def test_golden_keys(spark, info, key):
    df = spark.createDataFrame([(info,)], "info string")
    found = df.select(row_key(F.lit("20200106"), info_hash(F.col("info"))).alias("k")).first()["k"]
    assert found == key


def test_null_joins_as_text(spark):
    df = spark.createDataFrame([("r", "u", None)], "r string, u string, i string")
    assert df.select(joined_text(F.col("r"), F.col("u"), F.col("i")).alias("x")).first()["x"] == "runull"


def test_key_of_a_line(spark):
    row = with_row_key(parse_lines(lines_of(spark, line()))).first()
    assert row["rowkey"] == f"{DAY}_{zlib.crc32(b'-/a1.1.1.1')}"


def test_latest_line_wins(spark):
    early, late = line(0, agent="z"), line(5, agent="a")
    rows = latest_hits(lines_of(spark, late, early)).collect()
    assert [r["line"] for r in rows] == [late]


def test_tie_goes_to_the_greatest_line(spark):
    low, high = line(sent="1"), line(sent="2")
    assert [r["line"] for r in latest_hits(lines_of(spark, high, low)).collect()] == [high]


def test_line_without_time_loses(spark):
    timeless = line().replace("01/Jan", "99/Jan")
    assert [r["line"] for r in latest_hits(lines_of(spark, timeless, line())).collect()] == [line()]
    assert latest_hits(lines_of(spark, timeless)).count() == 1


def test_same_hit_on_two_days_is_two_rows(spark):
    both = lines_of(spark, line()).union(lines_of(spark, line(), day="20240102"))
    assert latest_hits(both).count() == 2


def test_all_hits_counts_lines_and_keyed_rows_counts_keys(spark):
    lines = lines_of(spark, line(0), line(1), line(2, url="/b"), "garbage")
    assert all_hits(lines).count() == 3
    assert keyed_rows(lines).count() == 2


def test_upsert_against_brute_force(spark):
    rng = random.Random(3)
    pairs = set()
    for _ in range(600):
        text = line(rng.randrange(20), url=f"/{rng.randrange(9)}", sent=str(rng.randrange(30)),
                    ip=rng.choice(["", "1.1.1.1", "2.2.2.2"]))
        pairs.add((rng.choice(["20240101", "20240102"]), text))
    expected = {}
    for day, text in pairs:
        ip, time, url = text.split(" ")[0], text.split("[")[1][:20], text.split(" ")[6]
        key = f"{day}_{zlib.crc32(('-' + url + (ip or 'null')).encode())}"
        expected[key] = max(expected.get(key, ("", "")), (time, text))
    lines = spark.createDataFrame(sorted(pairs), "day string, line string").repartition(7)
    found = {r["rowkey"]: r["line"] for r in latest_hits(lines).collect()}
    assert found == {key: text for key, (_, text) in expected.items()}
    assert len(found) == 2 * 9 * 3


def test_upsert_is_one_shuffle_with_partial_aggregation(spark, plan):
    text = plan(latest_hits(lines_of(spark, line())))
    assert text.count("Exchange ") == 1
    assert "partial_max" in text


def test_hot_key_is_reduced_before_the_shuffle(spark):
    texts = [line(i) for i in range(300)] + [line(i, url=f"/{i}") for i in range(20)]
    rows = latest_hits(lines_of(spark, *texts)).collect()
    assert len(rows) == 21
    assert line(299) in {r["line"] for r in rows}


def test_key_ranges_do_not_overlap(spark):
    lines = lines_of(spark, *[line(i, url=f"/{i}") for i in range(200)])
    rows = in_key_ranges(latest_hits(lines)).select(F.spark_partition_id().alias("p"), "rowkey")
    bounds = rows.groupBy("p").agg(F.min("rowkey").alias("a"), F.max("rowkey").alias("b"))
    ordered = sorted((r["a"], r["b"]) for r in bounds.collect())
    assert all(x[1] < y[0] for x, y in zip(ordered, ordered[1:]))
    assert rows.count() == 200


def test_cells(spark):
    rows = spark.createDataFrame(
        [("k1", "b1", None), ("k2", None, "a2")], "rowkey string, url string, ip string"
    )
    cells = [tuple(r) for r in to_cells(rows).collect()]
    assert cells == [("k1", "O", "url", "b1"), ("k2", "O", "ip", "a2")]


def test_cells_are_in_total_order(spark, plan):
    lines = lines_of(spark, *[line(i, url=f"/{i}") for i in range(100)])
    cells = sorted_cells(keyed_rows(lines))
    keys = [(r["rowkey"], r["qualifier"]) for r in cells.collect()]
    assert keys == sorted(keys)
    assert len(keys) == 100 * len(STORED_COLUMNS)
    text = plan(cells)
    assert text.index("Expand") < text.index("rangepartitioning")  # rows are moved, not cells


def test_sample_is_a_top_k(spark, plan):
    lines = lines_of(spark, *[line(i, url=f"/{i}") for i in range(30)])
    rows = keyed_rows(lines)
    sample = first_rows(rows, 10)
    assert "TakeOrderedAndProject" in plan(sample)
    keys = sorted(r["rowkey"] for r in rows.collect())
    assert [r["rowkey"] for r in sample.collect()] == keys[:10]


def test_stored_columns_drop_time(spark):
    ranges = spark.createDataFrame(
        [(0, 1, "c", "p")], "start_ip long, end_ip long, country string, province string"
    )
    rows = keyed_rows(lines_of(spark, line()), ranges)
    assert rows.columns == ["rowkey", *STORED_COLUMNS, *PLACE_COLUMNS, "day"]
    assert "time" not in rows.columns
