"""Shared-folder paths and the few file-system calls the sinks need.

All paths go through Hadoop's FileSystem, so the same code works on HDFS, object
stores and local disks.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a single local process takes a fresh folder and remembers it in the
    session; anything that has executors of its own is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="syncflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody else uses."""
    return f"{shared_dir(spark)}/syncflow/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table below the shared folder: computed once, and safe from lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly below ``path``; empty if there is no such path."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target))


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, such as a commit entry."""
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that appears complete or not at all."""
    fs, target = _fs(spark, path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        target.getParent(), f"_{uuid.uuid4().hex}.tmp"
    )
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs.delete(target, False)
    if not fs.rename(draft, target):
        raise OSError(f"could not write {path}")
