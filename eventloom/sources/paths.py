"""File-system helpers over the Hadoop API, so that every store Spark can read works."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# application id -> (the path class, the configuration): looking them up costs several calls each time
_HADOOP: dict[str, tuple] = {}


def _fs(spark: SparkSession, path: str):
    app = spark.sparkContext.applicationId
    if app not in _HADOOP:
        _HADOOP[app] = (spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration())
    kind, configuration = _HADOOP[app]
    where = kind(path)
    return where.getFileSystem(configuration), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; metadata only."""
    fs, where = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files directly below ``path``."""
    return [c for c in children(spark, path) if c[0] not in "._"]


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to the place of another one; nothing to do when it was moved before."""
    fs, here = _fs(spark, source)
    _, there = _fs(spark, target)
    if not fs.exists(here):
        return
    fs.delete(there, True)
    fs.mkdirs(there.getParent())
    if not fs.rename(here, there):
        raise OSError(f"cannot move {source} to {target}")


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a file; nothing to do when it was moved before."""
    fs, here = _fs(spark, source)
    _, there = _fs(spark, target)
    if not fs.exists(here):
        return
    fs.mkdirs(there.getParent())
    if not fs.rename(here, there):
        raise OSError(f"cannot move {source} to {target}")


def make(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.mkdirs(where)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, where = _fs(spark, path)
    out = fs.create(where, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# application id -> fallback folder of a local session
_LOCAL: dict[str, str] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables, below the shared folder the cluster names.

    Without ``spark.checkpoint.dir`` only a local master may fall back to a local folder: on a
    cluster the executors could not see it.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _LOCAL.get(context.applicationId) or tempfile.mkdtemp(prefix="eventloom-")
        _LOCAL[context.applicationId] = base
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
