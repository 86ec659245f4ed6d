"""Session settings and the shared scratch area."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_roots: dict[str, str] = {}


def build_session(app: str = "playlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; anything in ``conf`` wins.

    Shuffle partitions and executor sizes belong to the cluster and are not set here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Compressed files are larger in memory: count that when deciding on a broadcast.
        .config("spark.sql.sources.fileCompressionFactor", "3.0")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may do without it; there a temporary folder stands in.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="playlens-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def scratch_root(spark: SparkSession) -> str:
    """The part of the shared root that belongs to this application."""
    return os.path.join(shared_root(spark), "playlens", spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for this application."""
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex}")


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application pinned; DataFrames made from it cannot be read any more."""
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def pin(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared root and return a scan of the written table.

    Fixes values that a recomputation could change (partition numbers, ids), cuts the
    lineage in a way that outlives executors, and gives the planner the true size, so that
    it broadcasts the table only while it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(os.path.join(scratch_root(spark), "checkpoints"))


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Set SQL settings for the block; a stream started inside keeps them."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
