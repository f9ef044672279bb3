"""Access-log text, one record per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblytics.schema import LINE

LINE_OF_DAY = T.StructType([*LINE.fields, T.StructField("day", T.StringType(), True)])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LINE).text(path)


def read_log_day(spark: SparkSession, root: str, day: str) -> DataFrame:
    """``(line, day)`` of the files in ``<root>/<day>/``."""
    return read_lines(spark, f"{root}/{day}/*").withColumn("day", F.lit(day))


def read_log_days(spark: SparkSession, root: str) -> DataFrame:
    """``(line, day)`` of every ``<root>/day=<day>/``; a filter on ``day`` prunes folders."""
    return spark.read.schema(LINE_OF_DAY).text(root)


def stream_log_days(spark: SparkSession, root: str) -> DataFrame:
    """``(line, day)`` of the files that come to ``<root>/day=<day>/``, as a stream."""
    return spark.readStream.schema(LINE_OF_DAY).text(root)


def stream_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(LINE).text(path)
