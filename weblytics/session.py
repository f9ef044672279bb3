"""Local session for tests and the bench, and the folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "weblytics", memory: str = "8g") -> SparkSession:
    """A single-machine session. On a cluster the caller brings their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application; for the few parts that run Python in tasks."""
    context = spark.sparkContext
    if context.applicationId in _shipped or context.master.startswith("local"):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    made = tempfile.mkdtemp(prefix="weblytics-package-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{made}/weblytics", "zip", os.path.dirname(package), os.path.basename(package)))
    _shipped.add(context.applicationId)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``, which a cluster sets to shared storage, or else under the folder
    given to ``setCheckpointDir``. Only a local master may fall back to a folder of this machine,
    removed at exit.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/weblytics-{purpose}-{uuid.uuid4().hex}"
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix=f"weblytics-{purpose}-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    return f"{made}/data"
