"""Good and rejected lines written by one job, to a folder each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weblytics.operators.parse import GOOD, REJECTED, routed_lines
from weblytics.schema import REQUEST_COLUMNS

FIELDS = ("ip", "time", *REQUEST_COLUMNS, "status", "bytesent", "refer", "agent")
COUNTS = "lines"


def _counts() -> list:
    return [F.count_if(F.col("route") == route).alias(route) for route in (GOOD, REJECTED)]


def write_routes(lines: DataFrame, path: str) -> dict[str, int]:
    """Write ``<path>/route=good`` and ``route=rejected`` from one parse; the lines of each, counted on the way."""
    seen = Observation(COUNTS)
    routed = routed_lines(lines).observe(seen, *_counts())
    routed.write.partitionBy("route").parquet(path)
    return {route: seen.get[route] or 0 for route in (GOOD, REJECTED)}


def start_routes(lines: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The same on a stream: process what is there and stop. Each batch's counts are in its progress, under ``lines``."""
    return (
        routed_lines(lines).observe(COUNTS, *_counts())
        .writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("route")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def read_route(spark: SparkSession, path: str, route: str) -> DataFrame:
    """Good records, or rejected lines; other folders are not opened."""
    columns = ("line",) if route == REJECTED else FIELDS
    schema = ", ".join(f"{c} string" for c in (*FIELDS, "line", "route"))
    return spark.read.schema(schema).parquet(path).where(F.col("route") == route).select(*columns)
