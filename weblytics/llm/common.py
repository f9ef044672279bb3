"""What the operators share: fixed column names, tables in the shared folder, row numbers, skewed joins."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblytics.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
INDEX_BITS = 33  # of monotonically_increasing_id, below the partition number
HOT_SHARE = 1000  # a key above 1/1000 of the rows is hot, so fewer than 1000 keys are
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    top = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="weblytics-ship-"), "weblytics_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, top))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carried: Column | None = None) -> DataFrame:
    """Only ``doc_id BIGINT, text STRING``, and ``carried`` if given: further columns, whatever their names, cannot clash."""
    ship(docs.sparkSession)
    columns = [F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    return docs.select(*columns, *([] if carried is None else [carried.alias("carried")]))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def crc_of_id(doc_id: Column) -> Column:
    """CRC-32 of the id written in decimal, for the fixed train and held-out folds."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, keys: Sequence[str], purpose: str) -> tuple[DataFrame, int]:
    """Add ``row_number`` from 0 in the order of ``keys``, and count the rows.

    Rows are range-partitioned and sorted, then written with their place inside the partition; only
    one count for each partition comes to the driver. Rows equal in all keys may swap numbers. The
    place in the input is a last range key, so that equal rows do not meet in one partition.
    """
    spark = df.sparkSession
    ordered = (
        df.withColumn("_place", F.monotonically_increasing_id())
        .repartitionByRange(*keys, "_place")
        .sortWithinPartitions(*keys, "_place")
        .drop("_place")
    )
    stored = written(
        ordered.withColumn("_part", F.spark_partition_id()).withColumn(
            "_index", F.monotonically_increasing_id().bitwiseAND((1 << INDEX_BITS) - 1)
        ),
        purpose,
    )
    counts = sorted(tuple(r) for r in stored.groupBy("_part").count().collect())
    starts, total = [], 0
    for part, n in counts:
        starts.append((part, total))
        total += n
    table = spark.createDataFrame(starts, "_part int, _start bigint")
    return (
        stored.join(F.broadcast(table), "_part")  # one row for each partition
        .withColumn("row_number", F.col("_start") + F.col("_index"))
        .drop("_part", "_index", "_start"),
        total,
    )


def join_counted(left: DataFrame, right: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """Inner join where ``right`` has each key once with ``n``, its rows in ``left``.

    Keys above 1/1000 of those rows are broadcast, fewer than 1000 of them by definition, so their
    rows never meet in one task. The others are joined by shuffle. Both sides are read twice.
    """
    total = right.agg(F.sum(n)).first()[0] or 0
    hot = F.col(n) * HOT_SHARE > total
    few = right.where(hot)
    by_map = left.join(F.broadcast(few), keys)
    by_shuffle = left.join(F.broadcast(few.select(*keys)), keys, "left_anti").join(
        right.where(~hot).hint("merge"), keys
    )
    return by_map.unionByName(by_shuffle)
