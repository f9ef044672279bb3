"""The day table: replacement of single days, pruning, file order, absent columns."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from weblytics.operators.visits import browser_stat, visits_by_browser
from weblytics.plans.etl import load_day
from weblytics.schema import STORED_ROW
from weblytics.session import scratch_dir
from weblytics.sinks.day_table import replace_day, replace_days
from weblytics.sinks.results import read_browser_stat, replace_browser_stat
from weblytics.sources.day_table import reused, scan_day, scan_days
from weblytics.sources.logs import read_log_day, read_log_days

from test_keys import line


def rows_of(spark, *pairs):
    df = spark.createDataFrame(pairs, "day string, rowkey string, url string")
    return df.select(*[
        F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in STORED_ROW.names
    ])


def keys(df):
    return sorted((r["day"], r["rowkey"]) for r in df.collect())


def test_replacing_one_day_leaves_the_others(spark, tmp_path):
    root = str(tmp_path / "t")
    replace_days(rows_of(spark, ("20240101", "a", "/"), ("20240102", "b", "/")), root)
    replace_days(rows_of(spark, ("20240102", "c", "/")), root)
    assert keys(scan_days(spark, root)) == [("20240101", "a"), ("20240102", "c")]


def test_rerun_adds_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    for _ in range(2):
        replace_days(rows_of(spark, ("20240101", "a", "/")), root)
    assert scan_days(spark, root).count() == 1


def test_a_day_can_become_empty(spark, tmp_path):
    root = str(tmp_path / "t")
    both = rows_of(spark, ("20240101", "a", "/"), ("20240102", "b", "/"))
    replace_days(both, root)
    replace_day(both.where(F.lit(False)), root, "20240101")
    assert keys(scan_days(spark, root)) == [("20240102", "b")]


def test_failed_load_leaves_the_old_day(spark, tmp_path):
    root = str(tmp_path / "t")
    replace_day(rows_of(spark, ("20240101", "a", "/"), ("20240101", "b", "/")), root, "20240101")
    broken = rows_of(spark, ("20240101", "c", "/")).withColumn(
        "url", F.when(F.col("rowkey") == "c", F.raise_error(F.lit("lost"))).otherwise("/")
    )
    with pytest.raises(Exception, match="lost"):
        replace_day(broken, root, "20240101")
    assert keys(scan_days(spark, root)) == [("20240101", "a"), ("20240101", "b")]


def test_replace_day_takes_only_that_day(spark, tmp_path):
    root = str(tmp_path / "t")
    replace_day(rows_of(spark, ("20240101", "a", "/"), ("20240102", "b", "/")), root, "20240102")
    assert keys(scan_days(spark, root)) == [("20240102", "b")]


def test_day_scan_prunes_folders_and_columns(spark, tmp_path, plan):
    root = str(tmp_path / "t")
    replace_days(rows_of(spark, ("20240101", "a", "/"), ("20240102", "b", "/")), root)
    df = scan_day(spark, root, "20240101", ["rowkey", "country", "province", "browserName"])
    text = plan(df)
    assert "PartitionFilters: [isnotnull(day" in text
    read = "ReadSchema: struct<rowkey:string,browserName:string,country:string,province:string>"
    assert read in text
    assert [r["rowkey"] for r in df.collect()] == ["a"]


def test_day_stays_text(spark, tmp_path):
    root = str(tmp_path / "t")
    replace_days(rows_of(spark, ("20240101", "a", "/")), root)
    assert dict(scan_days(spark, root).dtypes)["day"] == "string"


def test_absent_column_reads_as_null(spark, tmp_path):
    root = str(tmp_path / "t")
    replace_days(rows_of(spark, ("20240101", "a", "/")).drop("country", "province"), root)
    row = scan_days(spark, root).first()
    assert (row["country"], row["rowkey"]) == (None, "a")


@pytest.fixture
def log_root(spark, tmp_path):
    root = str(tmp_path / "access")
    for day, count in (("20240101", 300), ("20240102", 40)):
        texts = [(line(i, url=f"/{i}"),) for i in range(count)] + [("garbage",)]
        spark.createDataFrame(texts, "line string").write.text(f"{root}/{day}")
    return root


@pytest.mark.parametrize("by_key", [False, True])
def test_daily_job(spark, log_root, tmp_path, by_key):
    root = str(tmp_path / "t")
    for day in ("20240101", "20240102", "20240101"):
        load_day(spark, log_root, day, root, by_key=by_key)
    assert scan_day(spark, root, "20240101").count() == 300
    assert scan_day(spark, root, "20240102").count() == 40
    assert visits_by_browser(scan_days(spark, root)).first()["cnt"] == 340
    bounds = []
    for name in glob.glob(f"{root}/day=*/*.parquet"):
        stored = pq.read_table(name, partitioning=None)["rowkey"].to_pylist()
        assert stored == sorted(stored)
        bounds.append((stored[0], stored[-1]))
    if by_key:
        bounds.sort()
        assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


def test_rows_in_one_frame_over_days_are_sorted_in_each_file(spark, tmp_path):
    root = str(tmp_path / "t")
    pairs = [(f"2024010{i % 3}", f"2024010{i % 3}_{(i * 7919) % 100:03}", "/") for i in range(90)]
    replace_days(rows_of(spark, *pairs), root)
    for name in glob.glob(f"{root}/day=*/*.parquet"):
        stored = pq.read_table(name, partitioning=None)["rowkey"].to_pylist()
        assert stored == sorted(stored)


def test_log_folders(spark, log_root, tmp_path):
    assert {r["day"] for r in read_log_day(spark, log_root, "20240102").collect()} == {"20240102"}
    root = str(tmp_path / "by-day")
    frame = spark.createDataFrame([("20240101", "x"), ("20240102", "y")], "day string, line string")
    frame.write.partitionBy("day").text(root)
    found = sorted((r["day"], r["line"]) for r in read_log_days(spark, root).collect())
    assert found == [("20240101", "x"), ("20240102", "y")]


def test_reuse_keeps_and_releases(spark):
    df = spark.range(10).toDF("n")
    with reused(df) as kept:
        assert kept.count() == 10
        assert kept.storageLevel.useMemory and kept.storageLevel.useDisk
    assert not df.storageLevel.useMemory


def test_browser_stat_is_replaced_by_day(spark, tmp_path):
    root = str(tmp_path / "stat")
    visits = spark.createDataFrame(
        [("20240101", "IE"), ("20240101", "IE"), ("20240102", None)], "day string, browserName string"
    )
    replace_browser_stat(browser_stat(visits), root)
    replace_browser_stat(browser_stat(visits.where("day = '20240102'")), root)
    rows = sorted(read_browser_stat(spark, root).collect(), key=lambda r: r["day"])
    assert [(r["day"], r["browsername"], r["cnt"]) for r in rows] == [
        ("20240101", "IE", 2), ("20240102", None, 1),
    ]
    assert dict(read_browser_stat(spark, root).dtypes)["cnt"] == "int"


def test_scratch_folders_are_new(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
