"""Paid-order results in batch."""

from datetime import datetime, timedelta

import pytest

from weblytics.operators import orders as O
from weblytics.plans.fixtures import events
from weblytics.sources.orders import stream_events
from weblytics.streaming.orders import live_orders, start_upsert
from weblytics.streaming.upsert import read_upserted

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


@pytest.fixture
def some(spark):
    base = datetime(2024, 3, 10, 1, 59, 30)  # the hour that New York skips follows
    kinds = ["purchase", "error", "view", "purchase", "purchase", "click"]
    rows = [
        (i, base + timedelta(seconds=20 * i, microseconds=500_000), 1, kinds[i % 6], 0.1 + i)
        for i in range(40)
    ]
    rows.append((99, datetime(1969, 12, 31, 23, 59, 59, 500_000), 1, "purchase", 2.0))
    return rows


def brute(rows, bucket):
    paid, placed, cents = {}, {}, {}
    for _, ts, _, kind, value in rows:
        key = bucket(ts)
        if kind in ("purchase", "error"):
            placed[key] = placed.get(key, 0) + 1
            paid[key] = paid.get(key, 0) + (kind == "purchase")
        if kind == "purchase":
            cents[key] = cents.get(key, 0) + round(value * 100)
    return paid, placed, cents


BUCKETS = {"day": "%Y-%m-%d 00:00:00", "hour": "%Y-%m-%d %H:00:00", "minute": "%Y-%m-%d %H:%M:00"}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("grain", list(BUCKETS))
def test_grains_in_any_session_zone(spark, some, grain, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        orders = O.orders_of_events(spark.createDataFrame(some, EVENTS))
        paid, placed, cents = brute(some, lambda ts: ts.strftime(BUCKETS[grain]))
        totals = {r["bucket"]: r for r in O.paid_totals(orders, grain).collect()}
        assert {k: round(r["paid_amount"] * 100) for k, r in totals.items()} == cents
        assert {k: r["paid_orders"] for k, r in totals.items()} == {k: paid[k] for k in cents}
        shares = {r["bucket"]: r for r in O.paid_share(orders, grain).collect()}
        assert {k: r["placed_orders"] for k, r in shares.items()} == placed
        assert {k: r["paid_share"] for k, r in shares.items()} == {k: paid[k] / placed[k] for k in placed}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(("size", "slide"), [(60, None), (120, 60), (180, 60), (100, 60), (3600, 900)])
def test_windows(spark, some, size, slide):
    windows = O.paid_windows(O.orders_of_events(spark.createDataFrame(some, EVENTS)), size, slide)
    found = {
        (r["window_start"], r["window_end"]): (r["paid_orders"], round(r["paid_amount"] * 100))
        for r in windows.collect()
    }
    expected = {}
    epoch = datetime(1970, 1, 1)
    for _, ts, _, kind, value in some:
        if kind != "purchase":
            continue
        seconds = (ts - epoch) // timedelta(seconds=1)
        step = slide or size
        start = seconds // step * step
        while start + size > seconds:
            key = tuple(str(epoch + timedelta(seconds=s)) for s in (start, start + size))
            count, cents = expected.get(key, (0, 0))
            expected[key] = (count + 1, cents + round(value * 100))
            start -= step
    assert found == expected


def test_filter_and_columns_reach_the_scan(spark, sf_dir, plan):
    text = plan(O.paid_totals(O.orders_of_events(events(spark, sf_dir)), "hour"))
    assert "EqualTo(event_type,purchase)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text
    assert "partial_sum" in text


def test_sliding_windows_copy_panes_not_rows(spark, sf_dir, plan):
    text = plan(O.paid_windows(O.orders_of_events(events(spark, sf_dir)), 3600, 900))
    assert text.index("explode") < text.index("partial_sum(coalesce(try_cast(rint")  # above the pane totals
    assert "Expand" not in text


@pytest.mark.parametrize("stream", [False, True], ids=["batch", "stream"])
def test_amounts_that_are_no_number(spark, tmp_path, stream):
    """Such orders are counted and add nothing."""
    amounts = [1.25, float("nan"), float("inf"), -float("inf"), 1e300, None]
    events = spark.createDataFrame([(i, 1, "purchase", a) for i, a in enumerate(amounts)], "event_id long, user_id long, event_type string, value double")
    events = events.selectExpr("event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "user_id", "event_type", "value")
    if stream:
        folder, out = str(tmp_path / "in"), str(tmp_path / "out")
        events.write.parquet(folder)
        results = O.paid_totals(live_orders(stream_events(spark, folder), None), "day")
        start_upsert(results, out, str(tmp_path / "cp")).awaitTermination()
        found = read_upserted(spark, out, results.schema, ["bucket"])
    else:
        found = O.paid_totals(O.orders_of_events(events), "day")
    assert [tuple(r)[1:] for r in found.select("bucket", "paid_orders", "paid_amount").collect()] == [(6, 1.25)]


def test_timestamp_stream_in_another_zone(spark, tmp_path):
    """A source with instants, not local times, is taken as it is."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        folder, out = str(tmp_path / "in"), str(tmp_path / "out")
        rows = spark.sql("SELECT timestamp_seconds(1704067200L) AS ts, 'purchase' AS event_type, 1.0D AS value")
        rows.write.parquet(folder)
        results = O.paid_totals(live_orders(spark.readStream.schema(rows.schema).parquet(folder), None), "hour")
        start_upsert(results, out, str(tmp_path / "cp")).awaitTermination()
        assert read_upserted(spark, out, results.schema, ["bucket"]).first()["bucket"] == "2024-01-01 00:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
