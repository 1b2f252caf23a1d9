"""Shared scratch space for cutting long plans and for small fitted tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_scopes: list[list[str]] = []


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system it lies; a missing one is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the scratch tables made inside the block when it ends. What is wanted later has to be
    written to its own place before that."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            remove_path(spark, path)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path below the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder: executors on other
    machines would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="run-")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to scratch and read it back: a short plan whose columns can be pruned, and
    which survives the loss of executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
