"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles start in many parts, which are joined to parts of a size afterwards: with the session's number alone, a task's rows
    # would grow with the input, and be spilled.  Up to 200 parts are written without a sort; 16 MB are some 600,000 narrow rows.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Medians of ratings keep a few values per group; hash that many groups before sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "100000",
    # Checkpoint files go with the tables that were cut off by them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Noting the Python call site of every column costs seconds per large plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else built, where they can still change."""
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "mercata", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators rely on: UTC dates, AQE with
    skew-join splitting, and no web page."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside are deleted when an action ends, instead of some time after the driver collects its
    garbage.  For tables that are written and read back: nothing asks for their shuffles again."""
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only where the cluster names none (local tests) is one set up here.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        named = tempfile.mkdtemp(prefix="mercata-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
