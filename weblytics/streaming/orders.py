"""Paid-order results as streams."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from weblytics.operators.orders import orders_of_events
from weblytics.streaming.upsert import start_upserted, upsert_writer

LATENESS = "1 hour"
STATE_PARTITIONS = 32


def live_orders(events: DataFrame, lateness: str | None = LATENESS) -> DataFrame:
    """Orders of an event stream, later than ``lateness`` dropped.

    With None nothing is ever dropped and every window stays open: for a backfill, whose files
    may come in any order. State is one row for each window, not for each event.
    """
    orders = orders_of_events(events)
    return orders.withWatermark("ts", lateness) if lateness else orders


@contextmanager
def _few_state_partitions(spark: SparkSession, state_partitions: int) -> Iterator[None]:
    """State is one row for each window, summed before the shuffle, so it needs far fewer partitions than the session's
    batch jobs. A query takes the setting when it starts, and keeps it in its checkpoint."""
    setting = "spark.sql.shuffle.partitions"
    of_session = spark.conf.get(setting)
    spark.conf.set(setting, min(int(of_session), state_partitions))
    try:
        yield
    finally:
        spark.conf.set(setting, of_session)


def start_upsert(
    results: DataFrame, path: str, checkpoint: str, state_partitions: int = STATE_PARTITIONS
) -> StreamingQuery:
    """Process what is there and stop, sending each changed window to the result folder."""
    spark = results.sparkSession
    start_upserted(spark, path, results.schema)
    writer = (
        results.writeStream.outputMode("update")
        .foreachBatch(upsert_writer(path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    with _few_state_partitions(spark, state_partitions):
        return writer.start()


def start_append(
    results: DataFrame, path: str, checkpoint: str, state_partitions: int = STATE_PARTITIONS
) -> StreamingQuery:
    """Process what is there and stop, writing each window once, when it is closed."""
    writer = (
        results.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    with _few_state_partitions(results.sparkSession, state_partitions):
        return writer.start(path)
