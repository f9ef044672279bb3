"""Stream state beyond the executors' memory, and its content held against the results."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblytics.functions.clock import seconds_text

_PREFIX = "spark.sql.streaming.stateStore"
_ON_DISK = {
    f"{_PREFIX}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_PREFIX}.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, of which memory holds a cache.

    Each batch writes the changes of the state to the checkpoint; whole copies follow in the background. A stream keeps
    its kind of store for as long as its checkpoint lives.
    """
    before = {k: spark.conf.get(k, None) for k in _ON_DISK}
    for k, v in _ON_DISK.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stored_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """``key, value, partition_id`` of a stateful operator after the last committed batch."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def open_totals(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that ``paid_totals`` still keeps, ``(bucket, paid_orders, paid_amount)``, from its state.

    The state's values are the buffers of count and sum, in the order of the aggregate.
    """
    state = stored_state(spark, checkpoint)
    count, cents = (F.col(f"value.{f.name}") for f in state.schema["value"].dataType.fields[:2])
    window = F.col(f"key.{state.schema['key'].dataType.fields[0].name}")
    return state.select(
        seconds_text(F.unix_seconds(window["start"])).alias("bucket"),
        count.alias("paid_orders"),
        (cents / F.lit(100.0)).alias("paid_amount"),
    )
