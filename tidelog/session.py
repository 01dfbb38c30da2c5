"""Shared working folders and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SHARED_DIR = "spark.checkpoint.dir"


def workspace(spark: SparkSession, label: str) -> str:
    """A new, never reused folder under the session's shared folder.

    The folder named by ``spark.checkpoint.dir`` is visible to every executor. Only a local-mode
    session without that setting gets a temporary one.
    """
    base = spark.conf.get(_SHARED_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_SHARED_DIR} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tidelog-")
        spark.conf.set(_SHARED_DIR, base)
    return f"{base.rstrip('/')}/tidelog/{label}-{uuid.uuid4().hex}"


def on_local_disk(spark: SparkSession) -> bool:
    """Whether the shared folder is on a disk mounted here, and not on a file system of its own."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(workspace(spark, "place"))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage on storage that outlives any executor, computes the rows once for all later
    readers, and gives the table a known size.
    """
    path = workspace(df.sparkSession, label)
    scope = _SCOPE.get()
    if scope is not None:
        scope.paths.append(path)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


class Scratch:
    """The tables staged inside one :func:`scratch` block, and those that outlive it."""

    def __init__(self):
        self.paths: list[str] = []
        self.kept: list[str] = []

    def keep(self, staged: DataFrame) -> DataFrame:
        """Spare a staged table that the block's result reads."""
        self.kept.append(staged._staged_at)
        return staged


_SCOPE: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Remove what is staged inside the block when it ends, but for what it keeps.

    A kept table belongs to the enclosing block, if there is one. Nothing that is removed is read
    again: results that are still to be computed may only rest on kept tables.
    """
    outer = _SCOPE.get()
    own = Scratch()
    token = _SCOPE.set(own)
    try:
        yield own
    finally:
        _SCOPE.reset(token)
        for path in own.paths:
            if path not in own.kept:
                remove(spark, path)
            elif outer is not None:
                outer.paths.append(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of this library's own making; one that is not there is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
