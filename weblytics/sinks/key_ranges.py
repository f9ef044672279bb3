"""A day table for look-ups by row key: files of disjoint key ranges, whose borders are kept and reused.

Layout: ``<root>/day=<day>/range=<number>/``, and the first keys of the ranges in ``<root>/_ranges``. A key's range follows
from the borders alone, so a look-up opens only the folders of its keys, and inside them the row groups whose Bloom
filter may hold one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weblytics.schema import STORED_ROW

RANGES = 64
BORDERS = "first_key string, range int"
_KEYED = [c for c in STORED_ROW.names if c != "day"]
STORED_KEYED = ", ".join([*[f"{c} string" for c in _KEYED], "day string", "range int"])


def _hash_text(rowkey: Column) -> Column:
    """The part of a row key behind the day: the same borders serve every day."""
    return F.substring_index(rowkey, "_", -1)


def key_borders(spark: SparkSession, root: str) -> list[str] | None:
    """First keys of the ranges after the first one, ascending: one for each range. None for a new table."""
    try:
        rows = spark.read.schema(BORDERS).parquet(f"{root}/_ranges").where("range > 0").orderBy("range").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return [r["first_key"] for r in rows]


def _find_borders(rows: DataFrame, root: str, ranges: int) -> list[str]:
    """Borders that deal these rows evenly, written beside the table: one row for each range is found in tasks."""
    key = _hash_text(F.col("rowkey")).alias("key")
    dealt = rows.select(key).repartitionByRange(ranges, "key").groupBy(F.spark_partition_id().alias("p"))
    firsts = sorted(r["first"] for r in dealt.agg(F.min("key").alias("first")).collect() if r["first"] is not None)
    borders = sorted(set(firsts[1:]))
    numbered = [("", 0), *[(k, i + 1) for i, k in enumerate(borders)]]
    rows.sparkSession.createDataFrame(numbered, BORDERS).coalesce(1).write.mode("overwrite").parquet(f"{root}/_ranges")
    return borders


def _range_of(rowkey: Column, borders: list[str]) -> Column:
    first = F.array(*[F.lit(b) for b in borders]).cast("array<string>")
    return F.size(F.filter(first, lambda b: b <= _hash_text(rowkey))).cast("int")


def replace_keyed_days(rows: DataFrame, root: str, ranges: int = RANGES) -> None:
    """Replace the days that occur in ``rows``. The first load finds the borders, later ones keep them.

    Rows go straight to the partition of their range, which writes one sorted file for each day it meets, so no range
    of any load overlaps another. A folder of a reloaded day that gets no rows is emptied after the write.
    """
    spark = rows.sparkSession
    borders = key_borders(spark, root)
    if borders is None:
        borders = _find_borders(rows, root, ranges)
    columns = [c for c in _KEYED if c in rows.columns]
    placed = rows.select(*columns, "day", _range_of(F.col("rowkey"), borders).alias("range"))
    before = {(r["day"], r["range"]) for r in _folders(spark, root)}
    seen = Observation("key-ranges")
    dealt = placed.repartitionById(len(borders) + 1, F.col("range")).sortWithinPartitions("day", "range", "rowkey")
    met = F.collect_set(F.struct("day", "range"))  # folders: days times ranges at most
    writer = dealt.observe(seen, met.alias("met")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer = writer.option("parquet.bloom.filter.enabled#rowkey", "true")
    writer.partitionBy("day", "range").parquet(root)
    now = {(r["day"], r["range"]) for r in seen.get["met"] or []}
    days = {day for day, _ in now}
    nothing = spark.createDataFrame([], placed.select(*columns).schema)
    for day, number in sorted(before - now):
        if day in days:
            nothing.write.mode("overwrite").parquet(f"{root}/day={day}/range={number}")


def _folders(spark: SparkSession, root: str) -> list:
    return spark.read.schema(STORED_KEYED).parquet(root).select("day", "range").distinct().collect()


def scan_keyed_days(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(STORED_KEYED).parquet(root).drop("range")


def rows_of_keys(spark: SparkSession, root: str, keys: DataFrame) -> DataFrame:
    """The stored rows of ``keys (rowkey)``; repeated and unknown keys add nothing.

    The folders of the keys, days times ranges at most, are listed first and no others are opened. The keys are then
    joined; Spark broadcasts them if they are few.
    """
    borders = key_borders(spark, root) or []
    rowkey = F.col("rowkey")
    wanted = keys.select("rowkey").where(rowkey.isNotNull()).distinct()
    placed = wanted.select(F.substring_index(rowkey, "_", 1).alias("day"), _range_of(rowkey, borders).alias("range"))
    by_day: dict[str, list[int]] = {}
    for row in placed.distinct().collect():
        by_day.setdefault(row["day"], []).append(row["range"])
    folders = F.lit(False)
    for day, numbers in sorted(by_day.items()):
        folders = folders | ((F.col("day") == day) & F.col("range").isin(numbers))
    return spark.read.schema(STORED_KEYED).parquet(root).where(folders).drop("range").join(wanted, "rowkey", "left_semi")
