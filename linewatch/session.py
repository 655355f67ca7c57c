"""Session defaults and the shared scratch location."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # recording the call site of every expression doubles the time to put a plan together
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def builder(app_name: str = "linewatch", **extra: str) -> SparkSession.Builder:
    """A session builder with the settings every job here relies on."""
    b = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        b = b.config(key, value)
    return b


def _shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or else a folder below the warehouse, which a cluster shares.

    A warehouse on a machine's own disk is refused under a cluster master.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    on_disk = warehouse.startswith("file:") or "://" not in warehouse
    if on_disk and not spark.sparkContext.master.startswith("local"):
        raise ValueError(
            "set spark.checkpoint.dir to a shared folder: executors cannot read " + warehouse)
    return warehouse.rstrip("/") + "/_scratch"


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder the cluster names in spark.checkpoint.dir."""
    path = f"{_shared_root(spark).rstrip('/')}/linewatch/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch folders taken inside go at the end, also after an error.

    Results of queries read them, so what is wanted of a result is written or collected inside.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove_path(spark, path)


def exists(spark: SparkSession, path: str) -> bool:
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(hadoop).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through the file system it lies in."""
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(hadoop).delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(hadoop).mkdirs(target)


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move the files of a folder into another one of the same file system, which may hold files of
    other names already."""
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    old, new = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    files = old.getFileSystem(hadoop)
    if not files.exists(new):
        files.mkdirs(new.getParent())
        pairs = [(old, new)]
    else:
        pairs = [(f.getPath(), jvm.org.apache.hadoop.fs.Path(new, f.getPath().getName()))
                 for f in files.listStatus(old)]
    for a, b in pairs:
        if not files.rename(a, b):
            raise OSError(f"{a} could not be moved to {b}")
