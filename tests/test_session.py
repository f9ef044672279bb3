"""The folder for intermediate tables."""

import pytest

from weblytics.session import scratch_dir


class Conf(dict):
    pass


class Context:
    def __init__(self, checkpoints):
        self.checkpoints = checkpoints

    def getCheckpointDir(self):
        return self.checkpoints


class Session:
    def __init__(self, checkpoints=None, **settings):
        self.conf = Conf({k.replace("_", "."): v for k, v in settings.items()})
        self.sparkContext = Context(checkpoints)


def test_checkpoint_folder_of_the_context_is_honoured():
    session = Session(checkpoints="hdfs://x/set", spark_master="yarn")
    assert scratch_dir(session, "a").startswith("hdfs://x/set/weblytics-a-")


def test_shared_folder_is_used_where_it_is_named():
    session = Session(spark_checkpoint_dir="hdfs://x/shared/", spark_master="yarn")
    first, second = scratch_dir(session, "a"), scratch_dir(session, "a")
    assert first.startswith("hdfs://x/shared/weblytics-a-")
    assert first != second


def test_local_master_may_use_its_own():
    assert "weblytics-a-" in scratch_dir(Session(spark_master="local[4]"), "a")


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session(spark_master="yarn"), "a")
