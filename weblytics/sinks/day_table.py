"""Writers of the day table. Each file is in row-key order, so a key look-up reads few row groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from weblytics.schema import STORED_ROW


def _stored(rows: DataFrame) -> DataFrame:
    columns = [c for c in STORED_ROW.names if c in rows.columns]
    return rows.select(*columns).sortWithinPartitions("day", "rowkey")


def replace_days(rows: DataFrame, root: str) -> None:
    """Replace the days that occur in ``rows`` and leave the others."""
    writer = _stored(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").parquet(root)


def replace_day(rows: DataFrame, root: str, day: str) -> None:
    """Replace one day with the rows of that day, even if there are none.

    The new files replace the folder when all of them are written; if the write fails, the old day is as it
    was. Only a day that turned out empty, known after that write, is emptied in a step of its own.
    """
    seen = Observation("day-rows")
    of_day = rows.where(F.col("day") == day).observe(seen, F.count(F.lit(1)).alias("n"))
    replace_days(of_day, root)
    if not seen.get["n"]:
        empty = rows.sparkSession.createDataFrame([], _stored(rows).drop("day").schema)
        empty.write.mode("overwrite").parquet(f"{root}/day={day}")
