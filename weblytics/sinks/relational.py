"""Browser results in a relational table, through Spark's JDBC source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblytics.schema import BROWSER_STAT
from weblytics.session import scratch_dir
from weblytics.sinks.results import RESULT_PARTITIONS

# --- Fixed values: definition of the result table ---
TABLE = "browser_stat"
COLUMNS = ("day", "browsername", "cnt")
COLUMN_TYPES = "day VARCHAR(10), browsername VARCHAR(100)"
# --- End of fixed values ---
NO_BROWSER = "none"  # the key columns take no nulls; a hit without agent is no browser
NO_DAY = "none"


def _writer(counts: DataFrame, mode: str, batch_size: int):
    keys = {
        "day": F.coalesce("day", F.lit(NO_DAY)),
        "browsername": F.coalesce("browsername", F.lit(NO_BROWSER)),
    }
    narrow = counts.select(*COLUMNS).withColumns(keys).repartition(RESULT_PARTITIONS)
    return (
        narrow.write.mode(mode)
        .option("createTableColumnTypes", COLUMN_TYPES)
        .option("batchsize", batch_size)
    )


def append_counts(
    counts: DataFrame, url: str, properties: dict, table: str = TABLE, batch_size: int = 1000
) -> None:
    """Batched inserts over two connections, one transaction each."""
    _writer(counts, "append", batch_size).jdbc(url, table, properties=properties)


def overwrite_counts(
    counts: DataFrame, url: str, properties: dict, table: str = TABLE, batch_size: int = 1000
) -> None:
    """Replace the whole table, keeping its definition."""
    writer = _writer(counts, "overwrite", batch_size).option("truncate", True)
    writer.jdbc(url, table, properties=properties)


def replace_day_counts(
    counts: DataFrame, day: str, url: str, properties: dict, table: str = TABLE
) -> None:
    """Replace the rows of one day in a table that exists, so that a rerun adds nothing twice.

    JDBC has no partition overwrite: the new content is written to the shared folder and read
    back before the table is emptied. If the second write fails, the error names that copy.
    """
    spark = counts.sparkSession
    existing = spark.read.jdbc(url, table, properties=properties).select(*COLUMNS)
    kept = existing.where((F.col("day") != day) | F.col("day").isNull())
    path = scratch_dir(spark, "browser-stat")
    fresh = counts.where(F.col("day") == day).select(*COLUMNS)
    kept.unionByName(fresh).repartition(RESULT_PARTITIONS).write.parquet(path)
    replacement = spark.read.schema(BROWSER_STAT).parquet(path)
    try:
        overwrite_counts(replacement, url, properties, table)
    except Exception as error:
        raise RuntimeError(f"{table} was not rewritten; its new content is in {path}") from error
