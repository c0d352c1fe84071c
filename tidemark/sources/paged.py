"""Spark data source ``paged``: the pages of a remote dataset, as they were sent.

A row is a page: ``body``, its JSON text, and ``after``, the key it follows (null for the first
of a range). Ranges of keys are planned first, each an input partition; a task reads from the
start of its range until nothing is left before the next one.

Options
    location        address of the service
    token           access token sent with every call
    timeout         seconds that one call may take (300)
    since           ISO date; read only rows changed since then
    page_stride     rows from the start of one range to the next, when planned (100000)
    page_limit      rows asked for by one call (10000, or the stride if that is less)
    pages_per_task  strides that one range covers (1)
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

import tidemark
from tidemark.sources.clients import HttpClient

FORMAT = "paged"
PAGE_SCHEMA = "after string, body string"
DEFAULT_STRIDE = 100_000
DEFAULT_LIMIT = 10_000
# Calls at the same time while ranges are planned.
PLANNING_CALLS = 8


@dataclass
class KeyRange(InputPartition):
    """Keys from ``start`` on and before ``stop``; None is open."""

    start: str | None
    stop: str | None


def page_starts(row_count: int, stride: int) -> range:
    """Row number at which each page starts; no pages where there are no rows."""
    return range(0, row_count, stride)


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.location = options["location"]
        self.token = options.get("token")
        self.timeout = int(options.get("timeout", 300))
        self.since = options.get("since") or None
        self.stride = int(options.get("page_stride", DEFAULT_STRIDE))
        self.limit = int(options.get("page_limit", min(self.stride, DEFAULT_LIMIT)))
        self.pages_per_task = int(options.get("pages_per_task", 1))
        if not 0 < self.limit <= self.stride or self.pages_per_task < 1:
            raise ValueError("need 0 < page_limit <= page_stride and pages_per_task >= 1")

    def _client(self) -> HttpClient:
        return HttpClient(self.location, self.token, self.timeout)

    def partitions(self) -> list[KeyRange]:
        client = self._client()
        starts = page_starts(client.count(self.since), self.stride * self.pages_per_task)
        with ThreadPoolExecutor(PLANNING_CALLS) as calls:
            found = list(calls.map(lambda at: client.key_at(at, self.since), starts[1:]))
        # Rows that went since the count leave starts beyond the end.
        keys = sorted({key for key in found if key is not None})
        if not len(starts):
            return []
        return [KeyRange(*ends) for ends in zip([None, *keys], [*keys, None])]

    def read(self, partition: KeyRange | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no pages: Spark still starts one read
            return
        client, after = self._client(), None
        while True:
            page = client.page(self.since, self.limit, partition.start, after, partition.stop)
            # A service may return fewer rows than asked for, so only none at all is the end.
            if not page.rows:
                return
            row = [pa.array([after], pa.string()), pa.array([page.body], pa.string())]
            yield pa.RecordBatch.from_arrays(row, ["after", "body"])
            after = page.last_key


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return PAGE_SCHEMA

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("paged")`` available."""
    # Ship the reader's code with the job, so that workers need not have the package.
    cloudpickle.register_pickle_by_value(tidemark)
    spark.dataSource.register(PagedSource)
