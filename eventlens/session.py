"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Shuffled data per partition.  AQE merges small partitions but never splits those of an aggregate or of a stream's state.
PARTITION_MB = 200

# Streaming state on disk, outside the heap.
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
STATE_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings that hold on a laptop and on a cluster alike.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    STATE_PROVIDER: STATE_ON_DISK,
}


def build_session(
    app: str = "eventlens", master: str | None = None, shuffled_gb: float | None = None, **conf: str
) -> SparkSession:
    """A session with the settings this library counts on.

    ``shuffled_gb`` is what the largest shuffle moves, or what a stream keeps as
    state: it gives the number of shuffle partitions, Spark's 200 at least.  A
    stream keeps the number it was first started with.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffled_gb is not None:
        settings["spark.sql.shuffle.partitions"] = str(max(200, math.ceil(shuffled_gb * 1024 / PARTITION_MB)))
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="eventlens-")


# The part of the scratch folder that is used at the moment; the whole folder unless ``temporary_scratch`` says otherwise.
_scope: ContextVar[str] = ContextVar("scratch_scope", default="")


def _scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = _local_root()
    return os.path.join(root, f"eventlens-{spark.sparkContext.applicationId}", _scope.get())


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder for intermediate tables that every executor can reach.

    The cluster names the parent in ``spark.checkpoint.dir``.  Only a local
    session without that setting falls back to this machine's temp folder.
    """
    return os.path.join(_scratch_root(spark), uuid.uuid4().hex)


def release_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results that still read them must be written before."""
    place = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def temporary_scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are deleted at the end; for what a stream does with every micro-batch."""
    token = _scope.set(os.path.join(_scope.get(), uuid.uuid4().hex))
    try:
        yield
    finally:
        release_scratch(spark)
        _scope.reset(token)


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, whatever the session is set to.

    Spark's keyed state with timers has no other store.  A stream keeps the
    settings it was started with, so the session gets its own back at the end.
    """
    before = spark.conf.get(STATE_PROVIDER)
    spark.conf.set(STATE_PROVIDER, STATE_ON_DISK)
    try:
        yield
    finally:
        spark.conf.set(STATE_PROVIDER, before)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage in a way that survives lost executors, pins the values of
    approximate aggregates, and gives Catalyst the true size of the table, so
    that it broadcasts the table in a later join only when it is small.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
