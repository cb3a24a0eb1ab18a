"""Session helpers.

``get_session`` builds a session with the settings this library expects
(AQE on, UI off, UTC).  ``shared_dir`` returns a directory every executor can
reach: the one the cluster names in ``spark.checkpoint.dir``.  Only when that
setting is missing on a local master does it make and register a fresh local
directory; on any other master it raises.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast a join side only on its measured size: the static planner's
    # estimate for a file is its compressed size, far below its size in
    # memory, so static broadcasting is off and adaptive execution decides
    # from the actual shuffle output.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lodestar", extra: dict | None = None) -> SparkSession:
    """Get or create a session with this library's defaults.

    On a cluster call it without ``master``; the submit command decides.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if master and master.startswith("local"):
        # Local mode: the driver JVM is the whole cluster.
        conf["spark.driver.memory"] = "16g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        d = spark.sparkContext.getCheckpointDir()
        if d:
            return d
    except Exception:  # Spark Connect has no SparkContext
        pass
    try:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            return d
    except Exception:
        pass
    return None


_made: list[str] = []


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """The name of a fresh sub-directory of the cluster's checkpoint directory.

    The base is read from the session (``spark.checkpoint.dir``).  Only on a
    local master, where every task runs on this machine, a missing setting is
    made up for by a new local directory; elsewhere it raises.  A base without
    a scheme, or with ``file:``, keeps its meaning (``file:`` stays in the
    name).
    """
    base = _configured_checkpoint_dir(spark)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master is {master})")
        base = tempfile.mkdtemp(prefix="lodestar-ckpt-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(base)
    if base.startswith("file:") and not base.startswith("file://"):
        base = "file://" + base.removeprefix("file:")
    path = f"{base.rstrip('/')}/{name or 'tmp'}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a directory of the shared folder, whatever file system it is on."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch(spark: SparkSession):
    """Directories that ``shared_dir`` names inside the block are deleted at its end,
    but for those in the list that the block gets (results that outlive it)."""
    start, keep = len(_made), []
    try:
        yield keep
    finally:
        for path in _made[start:]:
            if path not in keep:
                remove_dir(spark, path)
        _made[start:] = [p for p in _made[start:] if p in keep]


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """The shuffle files of a query that runs inside the block are deleted when it ends; otherwise they stay on the
    executors' disks until the driver's garbage collector finds them unused.  A DataFrame that is read again makes them anew."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back, the files of its shuffles deleted."""
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep ``df`` (memory, spilling to disk) for the passes made inside the
    block; a lost executor's blocks are recomputed from the lineage."""
    df = df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
