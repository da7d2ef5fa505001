"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a session whose executors all live in this process may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="almanac-"))
        folder = context.getCheckpointDir()
    return folder


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, which ``scratch`` deletes if it is open."""
    path = f"{shared_folder(spark).rstrip('/')}/almanac/{name}-{uuid.uuid4().hex}"
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Delete, at the end, exactly the tables in the shared folder that were begun within.

    For runs that write their results elsewhere. What is still to be computed from the tables must
    have been written before the end.
    """
    paths: list[str] = []
    token = _OWNED.set(paths)
    try:
        yield paths
    finally:
        _OWNED.reset(token)
        for path in paths:
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or directory wherever the path's file system keeps it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(written: DataFrame) -> None:
    """Delete a table of ``materialise`` or ``finished`` that nothing reads any more."""
    folders = {file.rpartition("/")[0] for file in written.inputFiles()}
    if len(folders) != 1 or "/almanac/" not in (folder := folders.pop()):
        raise ValueError("not a table of the shared folder")
    delete_path(written.sparkSession, folder)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The copy survives lost executors, is computed once however often it is used, and has a known
    size, from which Catalyst decides whether it may be broadcast.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def finished(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """``materialise`` what ``make`` returns, and delete the tables that were begun in it."""
    path = shared_path(spark, name)
    with scratch(spark):
        df = make()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits_broadcast(written: DataFrame) -> bool:
    """Whether Catalyst knows a written table to be small enough for a broadcast."""
    spark = written.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` on the executors for several queries and release it afterwards."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
