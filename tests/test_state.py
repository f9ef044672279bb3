import glob

from pyspark.sql import functions as F

from weblytics.operators import orders as O
from weblytics.schema import EVENTS
from weblytics.sources.orders import stream_events
from weblytics.streaming.orders import live_orders, start_upsert
from weblytics.streaming.state import open_totals, state_on_disk
from weblytics.streaming.upsert import read_upserted


def bag(frame):
    return sorted(map(tuple, frame.select("bucket", "paid_orders", "paid_amount").collect()))


def test_state_equals_the_open_windows(spark, sf_dir, tmp_path):
    folder, out, checkpoint = (str(tmp_path / p) for p in ("events", "out", "checkpoint"))
    source = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    middle = F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    for part in (middle, ~middle):
        source.where(part).write.mode("append").parquet(folder)
        results = O.paid_totals(live_orders(stream_events(spark, folder), "6 hours"), "hour")
        with state_on_disk(spark):
            start_upsert(results, out, checkpoint).awaitTermination()
    assert "RocksDB" not in str(spark.conf.get("spark.sql.streaming.stateStore.providerClass", ""))
    assert glob.glob(f"{checkpoint}/state/0/*/*.changelog") or glob.glob(f"{checkpoint}/state/0/*/*.zip")
    done = read_upserted(spark, out, results.schema, ["bucket"])
    assert bag(done) == bag(O.paid_totals(O.orders_of_events(source), "hour"))
    # Kept are the hours that end behind the watermark.
    newest = source.where(F.col("event_type") == O.PAID_EVENT).agg(F.max("ts")).first()[0]
    ended = F.col("bucket").cast("timestamp_ntz") + F.expr("interval 1 hour")
    still_open = done.where(ended > F.lit(newest).cast("timestamp_ntz") - F.expr("interval 6 hours"))
    assert bag(open_totals(spark, checkpoint)) == bag(still_open) and 0 < still_open.count() < done.count()
