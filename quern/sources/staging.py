"""Where intermediate results and stream state are written.

Everything goes below ``spark.checkpoint.dir``: on a cluster that is a folder
all executors share, so a lost executor loses nothing that was staged. Tables
stay until a ``scratch`` scope around the job closes.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a private one only for local sessions without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="quern-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_scopes: list[list[str]] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path no other run uses; an open scope removes it when it closes."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in any store that Spark writes to; nothing happens if there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in store.listStatus(target)] if store.exists(target) else []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes at its end all that was staged inside: close it when the results have been written."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove(spark, path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several passes must see the same rows; the lineage ends at the
    written table, and later passes prune columns from it.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
