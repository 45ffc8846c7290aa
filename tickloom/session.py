"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = {"spark.sql.session.timeZone": "UTC"}


def build_session(name: str = "tickloom", conf: dict[str, str] | None = None) -> SparkSession:
    """A session with what the operators rely on: UTC and adaptive execution.

    Sizing (shuffle partitions, executor memory) stays with the caller.
    """
    builder = SparkSession.builder.appName(name)
    settings = {**UTC, "spark.sql.adaptive.enabled": "true", **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Naive timestamps mean UTC everywhere; pin the session to it."""
    for key, value in UTC.items():
        spark.conf.set(key, value)
    return spark


def streaming_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A sibling session for streaming queries.

    The number of state partitions is frozen in a query's first checkpoint, so it
    is set here, apart from the batch session: ``partitions`` if given, else the
    number of cores Spark has. State lives in RocksDB, off the heap, and a
    checkpoint uploads the changes only.
    """
    sibling = use_utc(spark.newSession())
    sibling.conf.set(
        "spark.sql.shuffle.partitions", str(partitions or spark.sparkContext.defaultParallelism)
    )
    sibling.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    sibling.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    return sibling


def run_folder(spark: SparkSession) -> str:
    """A new folder for one run's checkpoints and tables.

    It lies under ``spark.checkpoint.dir``, which all executors must see. Only where that
    is unset and the master is local, as in tests, a temporary folder does.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/tickloom-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="run-")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def _store(spark: SparkSession, path: str):
    """The store that a path lies in, and the path as that store takes it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies; a missing one is no error."""
    store, target = _store(spark, path)
    store.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _store(spark, path)
    return store.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; a missing one has none."""
    store, target = _store(spark, path)
    return [found.getPath().getName() for found in store.listStatus(target)] if store.exists(target) else []
