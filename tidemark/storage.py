"""Hadoop file system calls, so that any storage Spark can reach works."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of its file system, for readers outside Hadoop."""
    fs, hadoop_path = _open(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file that readers see whole or not at all."""
    fs, to_path = _open(spark, path)
    if fs.exists(to_path):
        raise FileExistsError(path)
    aside = to_path.suffix(f".{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if not fs.rename(aside, to_path):
        raise OSError(f"could not name {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, from_path = _open(spark, path)
    stream = fs.open(from_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


class Folder:
    """A folder that can still be deleted after its session has stopped."""

    def __init__(self, spark: SparkSession, path: str):
        self._fs, self._path = _open(spark, path)

    def delete(self) -> None:
        self._fs.delete(self._path, True)

    def delete_at_exit(self) -> None:
        try:
            self.delete()
        except (Py4JError, OSError):
            pass  # the JVM has gone first
