"""Stored rows as cells ``(rowkey, family, qualifier, value)``, and samples of them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblytics.schema import COLUMN_FAMILY, PLACE_COLUMNS, STORED_COLUMNS


def to_cells(rows: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One cell for each non-null column of each row, qualifiers ascending within a row."""
    if columns is None:
        columns = [c for c in (*STORED_COLUMNS, *PLACE_COLUMNS) if c in rows.columns]
    cells = rows.unpivot("rowkey", sorted(columns), "qualifier", "value")
    return cells.where(F.col("value").isNotNull()).select(
        "rowkey", F.lit(COLUMN_FAMILY).alias("family"), "qualifier", "value"
    )


def sorted_cells(rows: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """All cells in (rowkey, qualifier) order, for rows whose key is unique.

    The rows are sorted before they are split: the range exchange then moves each row once
    instead of once for each column, and ``to_cells`` emits qualifiers in order.
    """
    return to_cells(rows.orderBy("rowkey"), columns)


def first_rows(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in row-key order."""
    return rows.orderBy("rowkey").limit(n)
