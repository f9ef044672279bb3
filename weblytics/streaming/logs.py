"""Streaming form of the log clean-up. Each step works on single lines, so no state is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from weblytics.plans.etl import clean_lines


def start_clean(lines: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process the lines that are there and stop; records go to Parquet files, each once."""
    return (
        clean_lines(lines)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
