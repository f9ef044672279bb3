"""The browser result as a Parquet table that is replaced day by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weblytics.schema import BROWSER_STAT

RESULT_PARTITIONS = 2


def replace_browser_stat(counts: DataFrame, root: str) -> None:
    """Replace the days of ``counts``. One row for each day and browser, so two tasks suffice to write."""
    writer = counts.select(*BROWSER_STAT.names).repartition(RESULT_PARTITIONS).write
    writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").parquet(root)


def read_browser_stat(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(BROWSER_STAT).parquet(root)
