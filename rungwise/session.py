"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "rungwise", **settings: str) -> SparkSession:
    """A session with the settings this library relies on.

    Nothing here fixes the cluster's size: ``master``, memory and
    ``spark.sql.shuffle.partitions`` come from spark-submit or ``settings``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A local master is one machine, so there (and only there) a temporary
    folder stands in when the setting is absent.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="rungwise-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a path that ``scratch_path`` gave and that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` materialised in the shared folder, its lineage cut."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cache_table(df: DataFrame) -> DataFrame:
    """Keep prepared rows for later passes; spills to disk, rebuilt if an executor is lost."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


@contextmanager
def cached(*frames: DataFrame):
    """Persist frames for the block, release them after it."""
    kept = [cache_table(frame) for frame in frames]
    try:
        yield kept[0] if len(kept) == 1 else kept
    finally:
        for frame in kept:
            frame.unpersist()
