import io
import random

import pytest
from pyspark.sql import functions as F

from weblytics.plans.fixtures import log_lines
from weblytics.sources.daylog import DayLogReader, lines_between, register_daylog
from weblytics.sources.logs import read_log_days


@pytest.fixture
def root(spark, sf_dir, tmp_path):
    register_daylog(spark)
    path = str(tmp_path / "log")
    log_lines(spark, sf_dir).repartition(3).write.partitionBy("day").text(path)
    return path


def load(spark, root, size):
    return spark.read.format("daylog").option("partitionbytes", size).load(root)


def bag(frame):
    return sorted(map(tuple, frame.select("line", "day").collect()))


@pytest.mark.parametrize("size", [500, 1 << 20])
def test_equals_the_text_source(spark, root, size):
    """Also where a file is larger than a partition."""
    frame = load(spark, root, size)
    assert [(f.name, f.dataType.simpleString()) for f in frame.schema] == [("line", "string"), ("day", "string")]
    assert bag(frame) == bag(read_log_days(spark, root))
    assert (frame.rdd.getNumPartitions() > 90) == (size == 500)  # three files for each of 30 days


def test_a_filter_of_the_day_lists_one_folder(spark, root):
    of_day = load(spark, root, 1 << 20).where((F.col("day") == "20240105") & F.contains("line", F.lit("POST")))
    assert bag(of_day) == bag(read_log_days(spark, root).where("day = '20240105' AND contains(line, 'POST')"))
    assert of_day.rdd.getNumPartitions() <= 3
    some = load(spark, root, 1 << 20).where(F.col("day").isin("20240105", "20240106", "19990101"))
    assert bag(some) == bag(read_log_days(spark, root).where("day IN ('20240105', '20240106')"))
    none = load(spark, root, 1 << 20).where("day = '19990101'")
    assert none.count() == 0


def test_every_line_belongs_to_one_range():
    """Against split, for lines of all lengths, empty ones, without a last break, and borders on breaks."""
    rng = random.Random(3)
    for _ in range(300):
        lines = [bytes(rng.choice(b"ab\r") for _ in range(rng.choice([0, 0, 1, 2, 7, 30]))) for _ in range(rng.randint(0, 12))]
        data = b"\n".join(lines) + (b"\n" if lines and rng.random() < 0.5 else b"")
        want = data.split(b"\n")
        if want[-1] == b"":
            want.pop()
        step = rng.randint(1, 20)
        found = []
        for a in range(0, len(data), step):
            for part in lines_between(io.BytesIO(data), len(data), a, min(a + step, len(data)), rng.randint(1, 9)):
                found += part
        assert found == want


def test_a_missing_folder_is_empty(tmp_path):
    parts = DayLogReader(str(tmp_path / "nothing"), 10).partitions()
    assert [p.path for p in parts] == [""]
