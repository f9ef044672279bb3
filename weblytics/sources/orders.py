"""Order events as a table and as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weblytics.schema import EVENTS


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(path)


def stream_events(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Files of ``path`` as a stream; ``path`` may be a file, a folder or a glob."""
    reader = spark.readStream.schema(EVENTS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    path = path.rstrip("/")
    if not set(path) & set("*?[{"):
        path = f"{path[:-1]}[{path[-1]}]"  # only as a glob is a single file accepted
    return reader.parquet(path)
