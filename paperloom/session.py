"""Session settings shared by jobs that must write intermediate tables."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a
    machine-local path would lose data together with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    fallback = tempfile.mkdtemp(prefix="paperloom-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


# A table up to this size may sit in a file or two that only as many tasks can read.
SMALL_TABLE_BYTES = 1 << 30


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a frame's size; nothing runs to find it."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def spread_small(df: DataFrame) -> DataFrame:
    """``df`` over all cores when it is small; a large one stays as it is read.

    For steps that compute much per row; the rows are the same either way.
    """
    if estimated_bytes(df) > SMALL_TABLE_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def release_memory() -> None:
    """Gives what a Python worker has freed back to the machine; its allocators would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(jvm_path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder on any Hadoop file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jvm_path))


def read_file(spark: SparkSession, path: str) -> str:
    """A small text file of any Hadoop file system."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(jvm_path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def publish_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that appears whole or not at all; an error if it is there already."""
    final = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(draft)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if fs.exists(final) or not fs.rename(draft, final):
        raise FileExistsError(path)
