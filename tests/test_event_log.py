import json
import os

import pytest

from weblytics.operators import orders as O
from weblytics.schema import EVENTS
from weblytics.sources.event_log import EventLogReader, stream_event_log
from weblytics.streaming.orders import live_orders, start_upsert
from weblytics.streaming.upsert import read_upserted, upsert_writer


def append(root, partition, events, first):
    folder = os.path.join(root, f"partition={partition}")
    os.makedirs(folder, exist_ok=True)
    name = f"{first:020d}-{first + len(events):020d}.jsonl"
    with open(os.path.join(folder, "." + name), "w") as f:
        f.write("".join(json.dumps(e) + "\n" for e in events))
    os.rename(os.path.join(folder, "." + name), os.path.join(folder, name))


@pytest.fixture
def events(spark, sf_dir):
    rows = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").orderBy("event_id").collect()
    return [{**r.asDict(), "ts": r.ts.isoformat()} for r in rows]


def drain(stream, write, checkpoint):
    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return [p.numInputRows for p in query.recentProgress if p.numInputRows]


def test_each_event_once_over_restarts(spark, tmp_path, events):
    """In batches of a bounded size, over three runs, with segments that come in between."""
    root, out, checkpoint = (str(tmp_path / p) for p in ("topic", "out", "checkpoint"))
    halves = [events[0::2], events[1::2]]
    sizes = []
    for a, z in ((0, 150), (150, 151), (151, 500)):
        for p, half in enumerate(halves):
            append(root, p, half[a:z], a)
        sizes.append(drain(stream_event_log(spark, root, 120), upsert_writer(out), checkpoint))
    assert max(max(s) for s in sizes) <= 120 and len(sizes[0]) >= 3 and sum(map(sum, sizes)) == len(events)
    found = spark.read.parquet(out)
    assert sorted(r.event_id for r in found.collect()) == [e["event_id"] for e in events]
    assert {r.event_id: r.ts.isoformat() for r in found.collect()} == {e["event_id"]: e["ts"] for e in events}


def test_a_killed_batch_is_read_again(spark, tmp_path, events):
    root, out, checkpoint = (str(tmp_path / p) for p in ("topic", "out", "checkpoint"))
    append(root, 0, events[:300], 0)
    write = upsert_writer(out)

    def fails(changed, batch):
        write(changed, batch)
        if batch == 1:
            raise RuntimeError("killed")

    with pytest.raises(Exception, match="killed"):
        drain(stream_event_log(spark, root, 100), fails, checkpoint)
    append(root, 0, events[300:], 300)
    drain(stream_event_log(spark, root, 100), write, checkpoint)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [e["event_id"] for e in events]


def test_totals_of_a_topic(spark, sf_dir, tmp_path, events):
    root, out, checkpoint = (str(tmp_path / p) for p in ("topic", "out", "checkpoint"))
    for p in range(3):
        append(root, p, events[p::3], 0)
    results = O.paid_totals(live_orders(stream_event_log(spark, root), lateness=None), "hour")
    start_upsert(results, out, checkpoint).awaitTermination()
    expected = O.paid_totals(O.orders_of_events(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")), "hour")
    assert sorted(map(tuple, read_upserted(spark, out, results.schema, ["bucket"]).collect())) == sorted(map(tuple, expected.collect()))


def test_offsets(tmp_path):
    root = str(tmp_path)
    append(root, 0, [{"event_id": k} for k in range(10)], 0)
    append(root, 0, [{"event_id": k} for k in range(10, 14)], 10)
    append(root, 1, [{"event_id": 50}], 0)
    reader = EventLogReader(root, 8)
    assert reader.initialOffset() == {}
    assert reader.latestOffset() == {"0": 4, "1": 1} and reader.latestOffset() == {"0": 8, "1": 1}
    parts = reader.partitions({"0": 8, "1": 1}, {"0": 12, "1": 1})
    assert [(p.skip, p.take) for p in parts] == [(8, 2), (0, 2)]
    read = [r["event_id"] for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert read == [8, 9, 10, 11]
    assert EventLogReader(str(tmp_path / "none"), 5).latestOffset() == {}
