"""Scans of the day table: Parquet, one ``day=<day>`` folder for each day."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblytics.schema import STORED_ROW


def scan_days(spark: SparkSession, root: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of every day. A column that a file lacks reads as null."""
    rows = spark.read.schema(STORED_ROW).parquet(root)
    return rows.select(*columns) if columns else rows


def scan_day(
    spark: SparkSession, root: str, day: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows of one day: other folders are not opened, other columns are not read."""
    rows = scan_days(spark, root).where(F.col("day") == day)
    return rows.select(*columns) if columns else rows


@contextmanager
def reused(rows: DataFrame) -> Iterator[DataFrame]:
    """Keep the rows for the queries inside the ``with``; select the needed columns first.

    Lost blocks are computed again from the table.
    """
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
