"""Intermediate tables that outlive the executors that wrote them."""

from __future__ import annotations

import atexit
import itertools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark import storage

_local_folders: list[tempfile.TemporaryDirectory] = []


def shared_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only for local masters."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return storage.qualified(spark, configured)
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local_folders:
        _local_folders.append(tempfile.TemporaryDirectory(prefix="tidemark-"))
    return storage.qualified(spark, _local_folders[0].name)


class Workspace:
    """A folder of intermediate tables, one per load or query.

    It goes when dropped, and at the latest when the process ends.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = f"{root or shared_root(spark)}/work-{uuid.uuid4().hex}"
        self._numbers = itertools.count()
        self._folder = storage.Folder(spark, self.root)
        atexit.register(self._folder.delete_at_exit)

    def path(self, name: str) -> str:
        return f"{self.root}/{next(self._numbers):02d}-{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a scan of what was written."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        atexit.unregister(self._folder.delete_at_exit)
        self._folder.delete()
