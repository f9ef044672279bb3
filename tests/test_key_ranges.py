import pytest
from pyspark.sql import functions as F

from weblytics.schema import STORED_ROW
from weblytics.sinks.key_ranges import key_borders, replace_keyed_days, rows_of_keys, scan_keyed_days


def rows(spark, day, numbers, mark="a"):
    data = [(f"{day}_{n * 7919 % 4294967296}", mark, day) for n in numbers]
    frame = spark.createDataFrame(data, "rowkey string, ip string, day string")
    others = [c for c in STORED_ROW.names if c not in ("rowkey", "ip", "day")]
    return frame.select("*", *[F.lit(None).cast("string").alias(c) for c in others])


def content(frame):
    return sorted((r["rowkey"], r["ip"]) for r in frame.collect())


def opened_folders(frame):
    """How many folders the scan lists after its partition filters."""
    leaves = frame._jdf.queryExecution().sparkPlan().collectLeaves()
    scans = [x for x in (leaves.apply(i) for i in range(leaves.size())) if "parquet" in x.nodeName()]
    return sum(x.relation().location().listFiles(x.partitionFilters(), x.dataFilters()).size() for x in scans)


@pytest.fixture
def table(spark, tmp_path):
    root = str(tmp_path / "table")
    replace_keyed_days(rows(spark, "20240101", range(4000)).unionByName(rows(spark, "20240102", range(3000))), root, 8)
    return root


def test_reload_keeps_borders_and_disjoint_files(spark, table):
    borders = key_borders(spark, table)
    assert len(borders) == 7 and borders == sorted(borders)
    replace_keyed_days(rows(spark, "20240102", range(2500, 9000), "b").unionByName(rows(spark, "20240103", range(10), "b")), table)
    assert key_borders(spark, table) == borders
    stored = scan_keyed_days(spark, table)
    want = content(rows(spark, "20240101", range(4000))) + content(rows(spark, "20240102", range(2500, 9000), "b"))
    assert content(stored) == sorted(want + content(rows(spark, "20240103", range(10), "b")))
    spans = stored.groupBy("day", F.input_file_name().alias("file")).agg(F.min("rowkey").alias("a"), F.max("rowkey").alias("z"))
    for day in ("20240101", "20240102", "20240103"):
        of_day = sorted((r["a"], r["z"]) for r in spans.where(F.col("day") == day).collect())
        assert all(x[1] < y[0] for x, y in zip(of_day, of_day[1:]))


def test_a_reload_with_few_rows_empties_the_other_folders(spark, table):
    replace_keyed_days(rows(spark, "20240101", [3], "new"), table)
    assert content(scan_keyed_days(spark, table).where("day = '20240101'")) == content(rows(spark, "20240101", [3], "new"))
    assert scan_keyed_days(spark, table).where("day = '20240102'").count() == 3000


def test_look_up_opens_the_folders_of_its_keys(spark, table):
    keys = rows(spark, "20240101", [5, 5, 17, 1]).select("rowkey").unionByName(
        spark.createDataFrame([("20240101_77",), ("20250101_5",), ("odd",), (None,)], "rowkey string")
    )
    found = rows_of_keys(spark, table, keys)
    assert content(found) == content(rows(spark, "20240101", [1, 5, 17]))
    folders = opened_folders(scan_keyed_days(spark, table))
    assert folders == 16 and 0 < opened_folders(found) <= 5


def test_no_keys(spark, table):
    none = spark.createDataFrame([], "rowkey string")
    assert rows_of_keys(spark, table, none).count() == 0


def test_bloom_filters_are_written(spark, table):
    import glob

    import pyarrow.parquet as pq

    file = glob.glob(f"{table}/day=20240101/range=0/*.parquet")[0]
    assert pq.ParquetFile(file).metadata.num_rows > 0
    with open(file, "rb") as f:
        raw = f.read()
    column = pq.ParquetFile(file).metadata.row_group(0).column(0)
    # The filter lies between the column data and the footer; without it the data would end where the footer begins.
    assert len(raw) - (column.data_page_offset + column.total_compressed_size) > 1024
