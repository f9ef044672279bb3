import json

import pytest
from pyspark.sql import functions as F

from weblytics.operators import orders as O
from weblytics.operators.upsert import latest_hits
from weblytics.plans.fixtures import log_lines
from weblytics.schema import EVENTS
from weblytics.sources.logs import stream_log_days
from weblytics.sources.orders import stream_events
from weblytics.streaming.keyed import live_latest_hits
from weblytics.streaming.orders import live_orders, start_append, start_upsert
from weblytics.streaming.upsert import read_upserted


def line(url, clock, agent="x", day="01"):
    return f'10.0.0.1 - - [{day}/Jan/2024:{clock} +0000] "GET {url} HTTP/1.1" 200 5 "-" "{agent}"'


class Feed:
    """Lines that come in steps to a stream of latest hits."""

    def __init__(self, spark, tmp_path, lateness="2 days"):
        self.spark, self.lateness = spark, lateness
        self.folder, self.path, self.checkpoint = (str(tmp_path / p) for p in ("log", "out", "checkpoint"))

    def step(self, *lines):
        frame = self.spark.createDataFrame(list(lines), "day string, line string")
        frame.write.mode("append").partitionBy("day").text(self.folder)
        hits = live_latest_hits(stream_log_days(self.spark, self.folder), self.lateness)
        self.schema = hits.schema
        query = start_upsert(hits, self.path, self.checkpoint)
        query.awaitTermination()
        return json.loads(query.lastProgress.json)["stateOperators"][0]["numRowsTotal"]

    def result(self):
        return read_upserted(self.spark, self.path, self.schema, ["day", "rowkey"])


def test_replays_and_late_lines_equal_the_batch(spark, sf_dir, tmp_path):
    lines = log_lines(spark, sf_dir)
    rows = [(r["day"], r["line"]) for r in lines.collect()]
    feed = Feed(spark, tmp_path, "60 days")
    for part in (rows[::3], rows[1::3] + rows[::3], rows[2::3] + rows[:100]):
        feed.step(*part)
    columns = ["day", "rowkey", "event_ts", "line", "url", "status"]
    assert sorted(map(tuple, feed.result().select(*columns).collect())) == sorted(
        map(tuple, latest_hits(lines).select(*columns).collect())
    )


def test_old_days_leave_the_state(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    assert feed.step(*[("20240101", line(f"/{k}", "01:00:00")) for k in range(20)]) == 20
    assert feed.step(("20240102", line("/a", "02:00:00", day="02")), ("20240101", line("/0", "05:00:00", "late"))) == 21
    assert feed.step(("20240110", line("/b", "02:00:00", day="10"))) == 1  # the days before are closed
    feed.step(("20240101", line("/0", "09:00:00", "too late")), ("20240110", line("/b", "01:00:00", "older", day="10")))
    urls = {(r["day"], r["url"]): r["agent"] for r in feed.result().collect()}
    assert len(urls) == 22
    assert urls["20240101", "/0"] == "late" and urls["20240110", "/b"] == "x"


def test_clocks_and_folders_that_are_wrong(spark, tmp_path):
    """A far time in a line closes nothing, a bad time competes as the least, a folder that is no day is dropped."""
    feed = Feed(spark, tmp_path)
    far = line("/far", "01:00:00").replace("2024", "2099")
    bad = line("/bad", "01:00:00").replace("[01/Jan", "[32/Jan")
    feed.step(("20240101", far), ("20240101", bad), ("today", line("/t", "01:00:00")))
    feed.step(("20240101", line("/bad", "03:00:00", "good time")), ("20240101", "garbage"))
    found = {r["url"]: r["agent"] for r in feed.result().collect()}
    assert found == {"/far": "x", "/bad": "good time"}


@pytest.mark.parametrize("size", [1800, 7200])
def test_windows_from_panes(spark, sf_dir, tmp_path, size):
    """Equal to the batch; the orders' state and the rows shuffled do not grow with the overlap."""
    slide = 900
    source = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    folder = str(tmp_path / "events")
    source.write.parquet(folder)
    last = source.agg((F.max("ts") + F.expr("interval 3 days")).alias("ts"), F.lit("purchase").alias("event_type"))
    spark.createDataFrame([], EVENTS).unionByName(last, allowMissingColumns=True).write.mode("append").parquet(folder)
    windows = O.live_windows_of_panes(live_orders(stream_events(spark, folder)), size, slide)
    query = start_append(windows, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    found = spark.read.schema(windows.schema).parquet(str(tmp_path / "out"))
    expected = O.paid_windows(O.orders_of_events(source), size, slide)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    panes = O.paid_windows(O.orders_of_events(source), slide).count() + 1
    progress = [json.loads(p.json) for p in query.recentProgress]
    firsts = [op["numRowsUpdated"] for p in progress if p["numInputRows"] for op in p["stateOperators"][-1:]]
    updated = [op["numRowsUpdated"] for p in progress if p["numInputRows"] for op in p["stateOperators"]]
    assert panes in updated and max(updated) == panes and firsts


def test_panes_need_whole_slides(spark, sf_dir):
    with pytest.raises(ValueError, match="multiple"):
        O.live_windows_of_panes(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"), 1000, 300)
