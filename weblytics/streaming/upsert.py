"""Stream results that are corrected as later data arrives."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BATCH = "batch_id"


def upsert_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function. Each batch has its own folder, so a replay replaces it."""
    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/{_BATCH}={batch}")

    return write


def start_upserted(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Make the result readable before the first batch, or if there is none. A folder that is there stays."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/{_BATCH}=-1")


def _written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    stored = T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType(), True)])
    return spark.read.schema(stored).parquet(path)


def _newest(stored: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    values = [c for c in schema.names if c not in keys]
    newest = F.max_by(F.struct(*values), F.col(_BATCH)).alias("_newest")
    latest = stored.groupBy(*keys).agg(newest)
    return latest.select(*keys, *[F.col(f"_newest.{v}").alias(v) for v in values])


def read_upserted(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]
) -> DataFrame:
    """For each key the row of the newest batch that wrote it."""
    return _newest(_written(spark, path, schema), schema, keys)


def fold_upserted(
    spark: SparkSession, path: str, target: str, schema: T.StructType, keys: Sequence[str]
) -> None:
    """Write the newest rows of many batches to a new folder, as two batches.

    For use between two runs of a stream, which then goes on with ``target`` and its checkpoint. The
    last batch may not be committed there, so a restart may write it again: it is copied as it is,
    and only the batches before it are folded, under the number below it. The old folder is left as it is.
    """
    stored = _written(spark, path, schema)
    last = stored.agg(F.max(_BATCH)).first()[0]
    last = -1 if last is None else last
    older = _newest(stored.where(F.col(_BATCH) < last), schema, keys)
    older.write.mode("overwrite").parquet(f"{target}/{_BATCH}={last - 1}")
    newest = stored.where(F.col(_BATCH) == last).select(*schema.names)
    newest.write.mode("overwrite").parquet(f"{target}/{_BATCH}={last}")
