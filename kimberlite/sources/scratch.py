"""Intermediate tables written to the shared scratch folder.

A staged table fixes its rows: later jobs read files instead of running the
plan again, so partition numbers stored in it stay true when executors are lost.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: dict[str, str] = {}
_opened = threading.local()

#: Whether Spark deletes what a query shuffled when the query ends, not when the driver collects its garbage.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[str, tuple[int, str | None]] = {}
_lock = threading.Lock()


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="kimberlite-")
    return _local_root[app]


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and return the written table.

    Only whoever gets the table reads it, so it has no marker of success: on a local
    store the driver starts two processes for each marker, to set its permissions.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/kimberlite/{name}-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", False).parquet(path)
    paths = getattr(_opened, "paths", None)
    if paths is not None:
        paths.append(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


@contextmanager
def freed_shuffles(spark: SparkSession):
    """What queries that begin inside the block have shuffled is deleted as they end.

    Nothing but the query itself reads it, and Spark would keep it until the driver
    collects its garbage: a driver with memory to spare lets the disks of executors
    fill. Blocks may nest and overlap in threads; the last to end restores the setting.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        inside, before = _freeing.get(session) or (0, spark.conf.get(_FREED, None))
        _freeing[session] = inside + 1, before
        spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        with _lock:
            inside, before = _freeing.pop(session)
            if inside > 1:
                _freeing[session] = inside - 1, before
            elif before is None:
                spark.conf.unset(_FREED)
            else:
                spark.conf.set(_FREED, before)


def stage_alone(spark: SparkSession, build: Callable[[], DataFrame], name: str = "stage") -> DataFrame:
    """Stage what ``build`` returns and delete what it staged on the way."""
    with staging(spark):
        staged = stage(build(), name)
        _opened.paths.remove(staged._staged_at)
    paths = getattr(_opened, "paths", None)
    if paths is not None:
        paths.append(staged._staged_at)
    return staged


def discard(staged: DataFrame) -> None:
    """Delete a table that ``stage`` returned, once all that is made of it has been written."""
    _delete(staged.sparkSession, staged._staged_at)
    paths = getattr(_opened, "paths", None)
    if paths is not None:
        paths.remove(staged._staged_at)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def staging(spark: SparkSession):
    """Delete the tables staged by this thread inside the block when it ends; blocks may nest."""
    outer, _opened.paths = getattr(_opened, "paths", None), []
    try:
        yield
    finally:
        paths, _opened.paths = _opened.paths, outer
        for path in paths:
            _delete(spark, path)
