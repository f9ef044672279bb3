"""Streams against the batch results, over several files and batches."""

import os
from datetime import datetime, timedelta

import pytest

from weblytics.operators import orders as O
from weblytics.operators.parse import parse_lines
from weblytics.operators.places import with_places
from weblytics.plans.etl import web_logs
from weblytics.schema import EVENTS, WEB_LOG
from weblytics.sources.logs import read_lines, stream_lines
from weblytics.sources.orders import read_events, stream_events
from weblytics.streaming.logs import start_clean
from weblytics.streaming.orders import live_orders, start_upsert
from weblytics.streaming.upsert import fold_upserted, read_upserted, start_upserted, upsert_writer

from test_keys import line

BASE = datetime(2024, 1, 1)


def write_events(spark, path, rows):
    """One more file in ``path``, newer than the files before it."""
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(path)
    os.sync()


def event(minutes, kind="purchase", value=1.0):
    return (int(minutes * 60), BASE + timedelta(minutes=minutes), 1, kind, value)


@pytest.fixture
def folder(spark, tmp_path):
    """Three files; the second and third change windows of the first, in no time order."""
    path = str(tmp_path / "events")
    write_events(spark, path, [event(m) for m in range(0, 180, 7)] + [event(3, "error")])
    write_events(spark, path, [event(m, value=0.25) for m in range(100, 400, 11)])
    write_events(spark, path, [event(m, "error") for m in range(0, 400, 13)] + [event(1, "view")])
    return path


def streamed(spark, tmp_path, path, summary, keys, lateness=None):
    results = summary(live_orders(stream_events(spark, path, files_per_trigger=1), lateness))
    out = str(tmp_path / "out")
    query = start_upsert(results, out, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    return read_upserted(spark, out, results.schema, keys), query


def rows(df):
    return sorted(tuple(r) for r in df.collect())


SUMMARIES = {
    "totals": (lambda o: O.paid_totals(o, "hour"), ["bucket"]),
    "share": (lambda o: O.paid_share(o, "minute"), ["bucket"]),
    "tumbling": (lambda o: O.paid_windows(o, 900), ["window_start", "window_end"]),
    "sliding": (lambda o: O.paid_windows(o, 3600, 900), ["window_start", "window_end"]),
}


@pytest.mark.parametrize("name", list(SUMMARIES))
def test_stream_of_several_batches_equals_batch(spark, tmp_path, folder, name):
    summary, keys = SUMMARIES[name]
    found, query = streamed(spark, tmp_path, folder, summary, keys)
    expected = summary(O.orders_of_events(read_events(spark, folder)))
    assert rows(found) == rows(expected)
    assert query.lastProgress["batchId"] >= 2


def test_stream_in_another_session_zone(spark, tmp_path, folder):
    summary, keys = SUMMARIES["totals"]
    expected = rows(summary(O.orders_of_events(read_events(spark, folder))))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows(streamed(spark, tmp_path, folder, summary, keys)[0]) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_watermark_drops_only_what_is_later_than_allowed(spark, tmp_path):
    path = str(tmp_path / "events")
    write_events(spark, path, [event(0), event(600)])
    write_events(spark, path, [event(601)])
    write_events(spark, path, [event(1), event(570)])  # 600 and 31 minutes late
    summary, keys = SUMMARIES["totals"]
    found, _ = streamed(spark, tmp_path, path, summary, keys, lateness="1 hour")
    counts = {r["bucket"]: r["paid_orders"] for r in found.collect()}
    assert counts == {
        "2024-01-01 00:00:00": 1, "2024-01-01 09:00:00": 1, "2024-01-01 10:00:00": 2,
    }


def test_restart_continues(spark, tmp_path, folder):
    summary, keys = SUMMARIES["totals"]
    streamed(spark, tmp_path, folder, summary, keys)
    write_events(spark, folder, [event(5), event(2000)])
    found, _ = streamed(spark, tmp_path, folder, summary, keys)
    assert rows(found) == rows(summary(O.orders_of_events(read_events(spark, folder))))


def test_state_has_its_own_partitions(spark, tmp_path, folder):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 50)
    try:
        results = O.paid_totals(live_orders(stream_events(spark, folder), None), "hour")
        query = start_upsert(results, str(tmp_path / "o"), str(tmp_path / "c"), state_partitions=3)
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("name", ["events.parquet", "events.*"])
def test_single_file_or_glob_as_a_stream(spark, tmp_path, sf_dir, name):
    summary, keys = SUMMARIES["totals"]
    found, _ = streamed(spark, tmp_path, f"{sf_dir}/{name}", summary, keys)
    expected = summary(O.orders_of_events(read_events(spark, f"{sf_dir}/events.parquet")))
    assert rows(found) == rows(expected)


def test_newest_batch_wins_and_a_replay_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    schema = spark.createDataFrame([], "k string, v long").schema
    start_upserted(spark, path, schema)
    assert read_upserted(spark, path, schema, ["k"]).count() == 0
    write = upsert_writer(path)
    for batch, found in ((2, [("a", 1), ("b", 1)]), (10, [("a", 5)]), (10, [("a", 6)])):
        write(spark.createDataFrame(found, schema), batch)
    assert rows(read_upserted(spark, path, schema, ["k"])) == [("a", 6), ("b", 1)]


def test_fold_between_two_runs(spark, tmp_path, folder):
    summary, keys = SUMMARIES["totals"]
    first, second, checkpoint = (str(tmp_path / n) for n in ("first", "second", "checkpoint"))
    results = summary(live_orders(stream_events(spark, folder, 1), None))
    start_upsert(results, first, checkpoint).awaitTermination()
    fold_upserted(spark, first, second, results.schema, keys)
    assert len([n for n in os.listdir(second) if n.startswith("batch_id=")]) == 2
    write_events(spark, folder, [event(5), event(2000)])
    results = summary(live_orders(stream_events(spark, folder, 1), None))
    start_upsert(results, second, checkpoint).awaitTermination()
    found = read_upserted(spark, second, results.schema, keys)
    assert rows(found) == rows(summary(O.orders_of_events(read_events(spark, folder))))


def test_replay_of_the_last_batch_after_a_fold(spark, tmp_path):
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    schema = spark.createDataFrame([], "k string, v long").schema
    start_upserted(spark, first, schema)
    write = upsert_writer(first)
    write(spark.createDataFrame([("a", 1), ("b", 1)], schema), 0)
    write(spark.createDataFrame([("b", 2)], schema), 1)
    fold_upserted(spark, first, second, schema, ["k"])
    start_upserted(spark, second, schema)
    assert rows(read_upserted(spark, second, schema, ["k"])) == [("a", 1), ("b", 2)]
    again = upsert_writer(second)
    again(spark.createDataFrame([("b", 3)], schema), 1)
    assert rows(read_upserted(spark, second, schema, ["k"])) == [("a", 1), ("b", 3)]
    again(spark.createDataFrame([("a", 4)], schema), 2)
    assert rows(read_upserted(spark, second, schema, ["k"])) == [("a", 4), ("b", 3)]


def test_fold_of_a_stream_without_batches(spark, tmp_path):
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    schema = spark.createDataFrame([], "k string, v long").schema
    start_upserted(spark, first, schema)
    fold_upserted(spark, first, second, schema, ["k"])
    upsert_writer(second)(spark.createDataFrame([("a", 1)], schema), 0)
    assert rows(read_upserted(spark, second, schema, ["k"])) == [("a", 1)]


@pytest.mark.parametrize(
    "limits", [{}, {"broadcast_bytes": 0}, {"widest_block": 0}, {"broadcast_bytes": 0, "widest_block": 0}],
    ids=["broadcast", "shuffled", "dense", "dense-shuffled"],
)
def test_places_of_a_log_stream(spark, tmp_path, limits):
    logs, out = str(tmp_path / "logs"), str(tmp_path / "out")
    texts = [(line(i, ip=f"10.{i}.0.1"),) for i in range(6)]
    spark.createDataFrame(texts, "line string").write.text(logs)
    ranges = spark.createDataFrame(
        [((10 << 24) + (i << 16), (10 << 24) + (i << 16) + 65_535, "c", f"p{i}") for i in range(4)],
        "start_ip long, end_ip long, country string, province string",
    )
    parsed = parse_lines(stream_lines(spark, logs)).select("ip")
    found = with_places(parsed, ranges, **limits)
    writer = found.writeStream.option("checkpointLocation", str(tmp_path / "cp"))
    writer.trigger(availableNow=True).format("parquet").start(out).awaitTermination()
    found = {r["ip"]: r["province"] for r in spark.read.parquet(out).collect()}
    assert found == {f"10.{i}.0.1": f"p{i}" if i < 4 else None for i in range(6)}


def test_log_stream_equals_batch(spark, tmp_path):
    logs, out = str(tmp_path / "logs"), str(tmp_path / "out")
    for part in range(2):
        texts = [(line(i, url=f"/{part}/{i}"),) for i in range(20)] + [("garbage",)]
        spark.createDataFrame(texts, "line string").write.mode("append").text(logs)
    for _ in range(2):  # the second run finds nothing new
        start_clean(stream_lines(spark, logs), out, str(tmp_path / "cp")).awaitTermination()
    found = spark.read.schema(WEB_LOG).parquet(out)
    assert rows(found) == rows(web_logs(read_lines(spark, logs)))
    assert found.count() == 40
