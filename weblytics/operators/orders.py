"""Paid-order counts, amounts and shares. The same functions serve tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblytics.functions.clock import ntz_instant, seconds_of, seconds_text

# --- Fixed values: grains, and what counts as placed and paid ---
GRAINS = {"day": "1 day", "hour": "1 hour", "minute": "1 minute"}
PLACED_EVENTS = ("purchase", "error")
PAID_EVENT = "purchase"
PAID_STATUS = "F"
# --- End of fixed values ---


def orders_of_events(events: DataFrame) -> DataFrame:
    """``(ts, paid, amount)`` of the placed orders among the events."""
    ts = F.col("ts")
    if events.isStreaming and isinstance(events.schema["ts"].dataType, T.TimestampNTZType):
        ts = ntz_instant(ts)
    return events.where(F.col("event_type").isin(*PLACED_EVENTS)).select(
        ts.alias("ts"),
        (F.col("event_type") == PAID_EVENT).alias("paid"),
        F.col("value").alias("amount"),
    )


def orders_of_table(orders: DataFrame) -> DataFrame:
    """``(ts, paid, amount)`` of the orders table; its dates have no time of day."""
    return orders.select(
        F.col("o_orderdate").alias("ts"),
        (F.col("o_orderstatus") == PAID_STATUS).alias("paid"),
        F.col("o_totalprice").alias("amount"),
    )


def _paid_measures(paid: DataFrame, *keys) -> DataFrame:
    """Count and amount in whole cents: integer sums do not depend on the order of addition.

    An order whose amount is null, NaN or beyond 64 bits of cents is counted and adds nothing.
    """
    cents = F.coalesce(F.rint(F.col("amount") * 100).try_cast("bigint"), F.lit(0))
    return paid.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("paid_orders"), F.sum(cents).alias("_cents")
    )


def _text(df: DataFrame, column: str):
    return seconds_text(seconds_of(df, column))


_AMOUNT = "_cents / 100.0D AS paid_amount"


def paid_totals(orders: DataFrame, grain: str) -> DataFrame:
    """Paid orders and their amount for each day, hour or minute."""
    totals = _paid_measures(orders.where("paid"), F.window("ts", GRAINS[grain]))
    return totals.select(
        _text(totals, "window.start").alias("bucket"), "paid_orders", F.expr(_AMOUNT)
    )


def paid_share(orders: DataFrame, grain: str) -> DataFrame:
    """Paid share of the placed orders for each day, hour or minute."""
    shares = orders.groupBy(F.window("ts", GRAINS[grain])).agg(
        F.count_if("paid").alias("paid_orders"), F.count(F.lit(1)).alias("placed_orders")
    )
    return shares.select(
        _text(shares, "window.start").alias("bucket"),
        "paid_orders",
        "placed_orders",
        (F.col("paid_orders") / F.col("placed_orders")).alias("paid_share"),
    )


def paid_windows(orders: DataFrame, size: int, slide: int | None = None) -> DataFrame:
    """Paid orders and amount for each window of ``size`` seconds, starting every ``slide``."""
    paid = orders.where("paid")
    if slide is None or slide == size or size % slide or orders.isStreaming:
        window = F.window("ts", f"{size} seconds", f"{slide or size} seconds")
        totals = _paid_measures(paid, window)
        return totals.select(
            _text(totals, "window.start").alias("window_start"),
            _text(totals, "window.end").alias("window_end"),
            "paid_orders",
            F.expr(_AMOUNT),
        )
    return _windows_from_panes(paid, size, slide)


def _windows_from_panes(paid: DataFrame, size: int, slide: int) -> DataFrame:
    """Sliding windows summed from panes of one slide each.

    A row belongs to ``size / slide`` windows; copying the few panes is cheaper than every row.
    """
    panes = _paid_measures(paid, F.window("ts", f"{slide} seconds"))
    back = F.explode(F.sequence(F.lit(0), F.lit(size - slide), F.lit(slide)))
    placed = panes.select(
        seconds_of(panes, "window.start").alias("_pane"), "paid_orders", "_cents", back.alias("_back")
    )
    start = F.col("_pane") - F.col("_back")
    totals = placed.groupBy(start.alias("_start")).agg(
        F.sum("paid_orders").alias("paid_orders"), F.sum("_cents").alias("_cents")
    )
    return totals.select(
        seconds_text(F.col("_start")).alias("window_start"),
        seconds_text(F.col("_start") + size).alias("window_end"),
        "paid_orders",
        F.expr(_AMOUNT),
    )


def live_windows_of_panes(orders: DataFrame, size: int, slide: int) -> DataFrame:
    """Sliding windows of a stream under a watermark, summed from panes of one slide each.

    Two aggregations in a chain: an order changes one pane, and a pane, once closed, its ``size / slide`` windows. So
    neither the rows shuffled nor the state of orders grows with that number. For append mode: a window
    comes out once, when the watermark has passed its end. Only paid orders move the watermark, because Spark filters
    before it takes the newest time.
    """
    if size % slide:
        raise ValueError("the size of a window is a multiple of its slide")
    panes = _paid_measures(orders.where("paid"), F.window("ts", f"{slide} seconds"))
    windows = panes.groupBy(F.window("window", f"{size} seconds", f"{slide} seconds")).agg(
        F.sum("paid_orders").alias("paid_orders"), F.sum("_cents").alias("_cents")
    )
    return windows.select(
        _text(windows, "window.start").alias("window_start"),
        _text(windows, "window.end").alias("window_end"),
        "paid_orders",
        F.expr(_AMOUNT),
    )
