"""Session construction and the shared scratch location.

Everything that has to be written (round trips, lineage cuts, streaming
checkpoints) goes below the folder the cluster names in
``spark.checkpoint.dir``; only a local session without that setting gets a
private folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that matter at scale: AQE re-plans joins and coalesces shuffle
# partitions at run time, skew join splits hot sort-merge partitions, and the
# session time zone is pinned so text timestamps never shift.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # The state of a stream lies on disk, not in the executors' heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "flightlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local-mode session without one gets its own
    folder; on a cluster the setting is required, since a machine-local
    folder is invisible to the other executors.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    root = tempfile.mkdtemp(prefix="flightlake-ckpt-")
    sc.setCheckpointDir(root)
    return (sc.getCheckpointDir() or root).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder below the checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python can stat a local path (tests only)."""
    return path[5:] if path.startswith("file:") else path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, asked through Hadoop so any file system works."""
    jvm = spark._jvm  # noqa: SLF001 - the Hadoop FileSystem API has no Python binding
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of our own once its last reader is done."""
    jvm = spark._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)  # noqa: SLF001


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
