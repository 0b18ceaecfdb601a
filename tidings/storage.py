"""Paths on whatever file system the session is configured for."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a Spark write to ``path`` was committed."""
    return exists(spark, f"{path}/_SUCCESS")


def matches(spark: SparkSession, pattern: str) -> bool:
    """True when at least one file fits the glob ``pattern``."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def folder_names(spark: SparkSession, path: str) -> list[str]:
    if not is_folder(spark, path):
        return []
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def delete(spark: SparkSession, path: str, recursive: bool = False) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.delete(p, recursive)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: the session's ``spark.checkpoint.dir``, which has to be set.

    In a local session, where one machine does everything, a folder set with ``setCheckpointDir`` or else a
    temporary one serves as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidings-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def file_state(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """Length and modification time of a file; None for a folder and for what doesn't exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    status = fs.getFileStatus(p)
    return None if status.isDirectory() else (status.getLen(), status.getModificationTime())


def first_bytes(spark: SparkSession, path: str, n: int) -> bytes:
    """At most the first ``n`` bytes of a file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(n))
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, data: bytes, replace: bool = False) -> None:
    """Make a small file, whole or not at all; one that exists is an error unless it may be replaced."""
    fs, p = _fs(spark, path)
    if fs.exists(p) and not replace:
        raise FileExistsError(path)
    _, draft = _fs(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    stream.write(bytearray(data))
    stream.close()
    if replace and fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(draft, p):
        fs.delete(draft, False)
        raise FileExistsError(path)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Give a file another name, in a folder that is made if need be; a file of that name is an error."""
    fs, p = _fs(spark, path)
    _, target = _fs(spark, to)
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(p, target):
        raise FileExistsError(to)


def files_at(spark: SparkSession, pattern: str) -> list[str]:
    """The files that a path or glob names, or that stand in a folder it names, as Spark would read them."""
    fs, p = _fs(spark, pattern)
    out = []
    for status in fs.globStatus(p) or []:
        found = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        out += [s.getPath().toString() for s in found if not s.isDirectory() and s.getPath().getName()[0] not in "._"]
    return sorted(out)


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_below(folder: str) -> Iterator[None]:
    """Put intermediate tables below ``folder``, so that they are removed together with it."""
    token = _scratch.set(folder.rstrip("/"))
    try:
        yield
    finally:
        _scratch.reset(token)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder of :func:`scratch_below`, else below the shared folder."""
    return f"{_scratch.get() or shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is executed inside has its shuffle files removed when it ends, not when the driver happens to collect garbage."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, path: str | None = None, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back, so later stages never recompute it.

    Used after model calls (whose answers may differ between runs) and before operators that read
    their input twice and need the same rows in the same files both times. Nothing reads the shuffles
    of the write again, so they don't stay on disk beside those of later stages.
    """
    spark = df.sparkSession
    target = path or scratch_path(spark, label)
    with shuffles_removed(spark):
        df.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path`` with the columns of ``schema``, or no rows if nothing is there."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    # Folder names such as batch_id=0 would otherwise add columns.
    return spark.read.schema(schema).parquet(path).select(*schema.names)
